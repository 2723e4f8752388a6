"""Golden values of the column expressions."""

import pytest
from pyspark.sql import functions as F

from factgrade import fixed
from factgrade.functions import facts, prompts, replies, scoring, text


def test_sentences(evaluate):
    got = evaluate(
        text.sentences("x"),
        ["Hello there. It costs 3.5 pounds! Ok? Yes", "", None, "  \n ", " a.\n\nb.  c ", "Dr. Smith left"],
    )
    assert got == [
        ["Hello there.", "It costs 3.5 pounds!", "Ok?", "Yes"],
        [],
        [],
        [],
        ["a.", "b.", "c"],
        ["Dr.", "Smith left"],
    ]


def test_tokens_keep_case_punctuation_and_empties(evaluate):
    assert evaluate(text.tokens("x"), ["The cat,  sat "]) == [["The", "cat,", "", "sat", ""]]


def test_word_set(evaluate):
    assert evaluate(text.word_set("x"), ["The cat, the CAT: 3.5 é!", "..."]) == [["the", "cat", "3", "5", "é"], []]


def test_head_counts_characters(evaluate):
    assert evaluate(text.head("x", 3), ["éèàù", None, "ab"]) == ["éèà", "", "ab"]
    assert len(evaluate(text.head("x"), ["é" * 5000])[0]) == 4096


def test_names(evaluate):
    assert evaluate(text.source_id("x"), ["eval_results_gpt.csv", "other"]) == ["gpt", "other"]
    assert evaluate(text.renamed_output("x", fixed.READY_SUFFIX), ["a.csv"]) == ["a_ready.csv"]
    assert evaluate(text.short_model_name("x"), ["host/org/m", "m"]) == ["m", "m"]


def test_label_id(evaluate):
    assert evaluate(text.label_id("x"), ["LABEL_3", "5", "odd"]) == [3, 5, None]


def test_claim_density(evaluate):
    assert evaluate(text.claim_density("a", "b"), [(100, 0), (100, 4)], "a int, b int") == [100.0, 25.0]


def test_parse_facts(evaluate):
    raw = ['["a","b"]', "['a','b']", "not json", None, "", '["a"] x', '["a"] ["b"]', "123", '{"a":1}', ' ["a"]\n', "[]"]
    assert evaluate(facts.parse_facts("x"), raw) == [["a", "b"], [], [], [], [], [], [], [], [], ["a"], []]


def test_parse_facts_or_lines(evaluate):
    raw = ["not json\n  b \n\n", '["a"]', None, "123", '{"a": 1}', '["a"] x', "\n"]
    assert evaluate(facts.parse_facts_or_lines("x"), raw) == [["not json", "b"], ["a"], [], [], [], ['["a"] x'], []]


def test_listed_facts(evaluate):
    assert evaluate(facts.listed_facts("x"), ["- a\nnoise\n * b \n-c", fixed.MOCK_REPLY, None, ""]) == [
        ["a", "b"],
        [],
        [],
        [],
    ]


def test_facts_json_round_trip(evaluate):
    listed = ['say "hi"', "back\\slash", "é\nline"]
    assert evaluate(facts.parse_facts(facts.facts_json("x")), [(listed,)], "x array<string>") == [listed]


def test_match_option(evaluate):
    got = evaluate(replies.match_option("x", ["YES", "NO"]), ["yes", "Yes, it is", "not so", "maybe", "", " No "])
    assert got == ["YES", "YES", "NO", "maybe", "YES", "NO"]


def test_says_yes(evaluate):
    assert evaluate(replies.says_yes("x"), ["oh yes", "no", None]) == [True, False, False]


def test_count_yes(evaluate):
    cases = {
        '{"decisions":["YES","no","Yes"]}': 2,
        '{"decisions":null}': 0,
        '["YES"]': 1,
        'junk "YES" "yes"': 2,
        "": 0,
        '{"other":["YES"]}': 0,
        '{"decisions":["YES"]} so "yes"': 2,
        '{"decisions":"YES"}': 0,
        '{"decisions":3,"x":"YES"}': 1,
        ' {"decisions":["YES",1,true]}\n': 1,
        "{'decisions':['YES']}": 0,
    }
    assert dict(zip(cases, evaluate(replies.count_yes("x"), list(cases)))) == cases
    assert evaluate(replies.count_yes("x"), [None]) == [0]


def test_reply_status(evaluate):
    got = evaluate(
        replies.reply_status("x"),
        ["ERROR: 429 too many", "ERROR: bad key", "", None, "fine", "ERROR: Timed Out", "see error 429"],
    )
    assert got == ["temporary", "permanent", "missing", "missing", "ok", "temporary", "ok"]


def test_keyword_refusals(evaluate):
    got = evaluate(scoring.looks_refused("x"), ["I'm sorry, no", "We ask: as an AI?", "has an aide", "Hi cannot", None])
    assert got == [True, True, False, False, False]


def test_refusal_rule(evaluate):
    rows = [(5, 0.99), (3, 0.99), (1, 0.92), (1, 0.925), (0, 0.99)]
    assert evaluate(scoring.is_refusal("a", "b"), rows, "a int, b double") == [False, False, False, True, True]


@pytest.mark.parametrize(
    ("counts", "expected"),
    [
        ((2, 4, 2), (0.5, 1.0, 2 / 3)),
        ((0, 3, 2), (0.0, 0.0, 0.0)),
        ((0, 0, 2), (0.0, 0.0, 0.0)),
        ((0, 3, 0), (0.0, 0.0, 0.0)),
        ((5, 4, 3), (1.0, 1.0, 1.0)),
    ],
)
def test_f1(evaluate, counts, expected):
    schema = "s int, g int, k int"
    got = [
        evaluate(e, [counts], schema)[0]
        for e in (scoring.precision_at_k("s", "g"), scoring.recall_at_k("s", "k"), scoring.f1_at_k("s", "g", "k"))
    ]
    assert got == pytest.approx(list(expected))


def test_overlapping_claims(evaluate):
    row = (["The cat sat.", "Dogs bark loudly", "...", "cat dog"], ["A cat sat on the mat"])
    got = evaluate(scoring.overlapping_claims("c", "r"), [row], "c array<string>, r array<string>")
    assert got == [["The cat sat.", "cat dog"]]


def test_prompt_templates_keep_inserted_braces(evaluate):
    got = evaluate(
        prompts.claim_messages("c", "r"), [("is {reference_text}?", ["{claim}", "b"])], "c string, r array<string>"
    )[0]
    assert [m["role"] for m in got] == ["system", "user"]
    assert got[1]["content"].startswith("Premise:\n- {claim}\n- b\n\nHypothesis:\nis {reference_text}?\n\nDoes")


def test_check_all_messages(evaluate):
    got = evaluate(prompts.check_all_messages("c", "r"), [(["x", "y"], ["a"])], "c array<string>, r array<string>")[0]
    assert got[0]["content"] == (
        "Reference Facts:\n    - a\n\n    Claims to Verify:\n    1. x\n2. y\n\n"
        '    Return a JSON object with the key "decisions" containing a list of "YES" or "NO" for each claim.\n'
        '    Example: {"decisions": ["YES", "NO"]}'
    )


def test_split_messages(spark):
    df = spark.createDataFrame(
        [("s", [("e1", ["f1", "f2"]), ("e2", ["f3"])])],
        "sentence string, examples array<struct<sentence:string,facts:array<string>>>",
    )
    got = df.select(prompts.split_messages("sentence", F.col("examples")).alias("m")).first()["m"]
    lead = "Please breakdown the following input into independent facts, avoiding repetition: "
    assert [(m["role"], m["content"]) for m in got[1:]] == [
        ("user", lead + "e1"),
        ("assistant", "- f1\n- f2"),
        ("user", lead + "e2"),
        ("assistant", "- f3"),
        ("user", lead + "s"),
    ]
    assert got[0]["content"] == fixed.SPLIT_SYSTEM


def test_flatten_messages(evaluate):
    got = evaluate(
        prompts.flatten_messages("m"), [([("system", "a"), ("user", "b")],)], "m array<struct<role:string,content:string>>"
    )
    assert got == ["SYSTEM: a\nUSER: b\nASSISTANT:"]


def test_equal_prompts_have_equal_hashes(evaluate):
    schema = "m array<struct<role:string,content:string>>"
    got = evaluate(prompts.prompt_hash("m"), [([("user", "a")],), ([("user", "a")],), ([("user", "b")],)], schema)
    assert got[0] == got[1] != got[2]
