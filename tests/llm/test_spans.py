"""Personal data and secrets."""

import random
import time

from llm import brute
import pytest

from factgrade.llm import pii, secrets
from factgrade.llm.queries import QUERIES


@pytest.fixture(scope="module")
def field(texts):
    return pii.train([t for t in texts.values() if any(c.isdigit() for c in t)])


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("a1.@+- ()012345678925.12.@b-_%\n") for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == brute.pii(text)
        parts = ["password", "Token", "api_key", "=", ":", " ", '"', "'", "AKIA", "0f", "abc123", "Zz9/+", "KAPI", "ſecret", "\n", "ef01"]
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        assert secrets.base_spans(text) == brute.secrets(text)


def test_op1_whole_table(spark, sf, texts):
    for r in QUERIES["op1_pii"](spark, sf).collect():
        spans = brute.pii(texts[r["doc_id"]])
        assert r["base_sha256"] == brute.digest(spans)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r["spans"].split(","))


def test_op2_whole_table(spark, sf, texts):
    for r in QUERIES["op2_secrets"](spark, sf).collect():
        spans = brute.secrets(texts[r["doc_id"]])
        assert r["base_sha256"] == brute.digest(spans)
        assert [r[f"n_{k}"] for k in secrets.KINDS[:3]] == [sum(s[0] == k for s in spans) for k in secrets.KINDS[:3]]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("call (415) 555-2671 now", ("phone", "(415) 555-2671")),
        ("tel 415-555-2671, ok", ("phone", "415-555-2671")),
        ("pay 4111.1111.1111.1111 x", ("card", "4111.1111.1111.1111")),
        ("la +1 (269) 555-3296 4524132264652876 and", ("phone", "+1 (269) 555-3296")),
        ("la +1 (269) 555-3296 4524132264652876 and", ("card", "4524132264652876")),
    ],
)
def test_field_adds_what_the_patterns_miss(field, text, found):
    assert found in [(s["kind"], text[s["start"] : s["end"]]) for s in pii.spans(text, field)]


@pytest.mark.parametrize("text", ["on 2024-01-02 at 10 of 1234567 things", "version 1.2.3 and 300.1.2.3", "12 + 30 = 42", "a b c"])
def test_field_leaves_other_numbers(field, text):
    assert pii.spans(text, field) == []


def test_likelihood_grows_with_training(texts):
    some = [t for t in texts.values() if any(c.isdigit() for c in t)][:40]
    short, long = pii.train(some, rounds=1), pii.train(some, rounds=6)
    assert abs(long.weights).sum() > abs(short.weights).sum() > 0


@pytest.mark.parametrize(
    ("text", "literal"),
    [
        ('KEY = "abcdEF123456xyz"\ndb_password = KEY', "abcdEF123456xyz"),
        ("client_secret: ${KEY}\nKEY=Zx81_kkQpLm00", "Zx81_kkQpLm00"),
        ("a = b\nb = c\nc = 'Zx81kkQpLm00aa'\nauthToken => a", "Zx81kkQpLm00aa"),
        ('private_key := "aa" + "bbCC1234xx"', "bbCC1234xx"),
        ("Authorization: Bearer Zx81kkQpLm00aa", "Zx81kkQpLm00aa"),
        ("<db:password type='x'> Zx81kkQpLm00aa </db:password>", "Zx81kkQpLm00aa"),
        ("run --db-password Zx81kkQpLm00aa now", "Zx81kkQpLm00aa"),
        ('conn.set_password("Zx81kkQpLm00aa")', "Zx81kkQpLm00aa"),
        ("k = 'Zx81kkQpLm00aa'\nset_password(k)", "Zx81kkQpLm00aa"),
        ('pwd = """Zx81kkQpLm00aa"""', "Zx81kkQpLm00aa"),
        ("signing_key: |\n  AAAA1111bbbb\n  Zx81kkQpLm00aa\nother: x", "Zx81kkQpLm00aa"),
        ('pwd = os.getenv("X", "Zx81kkQpLm00aa")', "Zx81kkQpLm00aa"),
        ('X = "Zx81kkQpLm00aa"\npwd = os.getenv("X")', "Zx81kkQpLm00aa"),
        ('base = "aaBB1122cc"\nsuffix = "Zx81kkQpLm00aa"\npwd = base + suffix', "Zx81kkQpLm00aa"),
        ("b='Zx81kkQpLm00aa'\nc='yyQ1kkQpLm'\npwd=b+c", "Zx81kkQpLm00aa"),
        ("open postgres://user:Zx81kkQpLm00aa@host/db", "Zx81kkQpLm00aa"),
        ("a=b=Zx81kkQpLm00aa==\npwd=a", "Zx81kkQpLm00aa=="),
    ],
)
def test_constants_flow_into_sensitive_names(text, literal):
    assert literal in [text[s["start"] : s["end"]] for s in secrets.spans(text) if s["kind"] == "literal"]


HARMLESS = [
    'pwd = os.getenv("DB_PASSWORD_FOR")', 'pwd = headers["X-Auth-Token"]', 'get_token("Zx81kkQpLm00aa")', "Note: basic understanding",
    "<title>Zx81kkQpLm00aa</title>", "run --color Zx81kkQpLm00aa", "title: |\n  Zx81kkQpLm00aa\n", "see https://host:8080/token", "--password",
]


@pytest.mark.parametrize("text", ['password = "changeme"', "color = 'Zx81kkQpLm00aa'", "if token == x:", "see http://token", "a = b\nb = a\nsecret = a", *HARMLESS])
def test_other_assignments_are_left(text):
    assert [s for s in secrets.spans(text) if s["kind"] == "literal"] == []


FORMS = [
    "Authorization: Bearer {}", "<secret>{}</secret>", "deploy --api-key {} --fast", 'vault.store_secret("{}")', "pwd = '''{}'''",
    "passphrase: |\n    {}\n", 'jwt = env("J", "{}")', "mongodb://me:{}@db.host/x", "K1 = '{}'\nK2 = K1\naccess_key = K2",
]


def test_planted_forms_over_the_table(texts):
    """Secrets put into texts of the table are found, each as itself, and nothing else is added to these texts."""
    rng = random.Random(8)
    letters = "abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"
    planted = added = hits = 0
    for k, text in enumerate(t for t in texts.values() if t):
        before = sum(s["kind"] == "literal" for s in secrets.spans(text))
        value = "".join(rng.choice(letters) for _ in range(20))
        whole = text + "\n" + FORMS[k % len(FORMS)].format(value) + "\n"
        found = [whole[s["start"] : s["end"]] for s in secrets.spans(whole) if s["kind"] == "literal"]
        planted, added, hits = planted + 1, added + len(found) - before, hits + (value in found)
    assert hits == planted and added == planted


def reached_literals(definitions, uses):
    """Which literals reach a use, by plain search: each name is a literal's or a sum of other names."""
    found, todo, seen = set(), list(uses), set()
    while todo:
        name = todo.pop()
        if name not in seen:
            seen.add(name)
            for value in definitions.get(name, []):
                found |= {value} if isinstance(value, str) else set()
                todo += value if isinstance(value, list) else []
    return found


def test_flow_against_plain_search():
    rng = random.Random(4)
    for _ in range(300):
        names = [f"n{i}" for i in range(12)]
        definitions, lines = {}, []
        for name in names:
            for _ in range(rng.choice((1, 1, 2))):
                if rng.random() < 0.5:
                    value = "Q7z" + "".join(rng.choice("abcdefghkmXYZW23456789") for _ in range(14))
                    lines.append(f'{name} = "{value}"')
                else:
                    value = rng.sample([n for n in names if n != name], rng.choice((1, 2)))
                    lines.append(f"{name} = {' + '.join(value)}")
                definitions.setdefault(name, []).append(value)
        uses = rng.sample(names, 2)
        lines += [f"db_secret = {u}" for u in uses]
        rng.shuffle(lines)
        text = "\n".join(lines)
        assert {text[a:b] for a, b, _, _ in secrets.flowing_literals(text)} == reached_literals(definitions, uses)


def test_long_texts_take_time_in_proportion():
    n = 250_000
    chain = "".join(f"k{i} = k{i + 1}\n" for i in range(n // 2)) + f"k{n // 2} = 'Zx81kkQpLm00aa'\n" + "secret = k0\n" * 10_000
    for text in ("password = 'Zx81kkQpLm00aa'\n" * (n // 4), chain, "x=" * n, 'pwd="""' * n, "pwd(a," * n):
        start = time.perf_counter()
        secrets.spans(text)
        assert time.perf_counter() - start < 30


def test_edges(edges, empty, field):
    assert pii.find_pii(edges).count() == edges.count() and secrets.find_secrets(edges).count() == edges.count()
    assert pii.find_pii(empty).count() == 0 and secrets.find_secrets(empty).count() == 0
    clean = pii.redact(edges, field)
    assert clean.columns == edges.columns
    rows = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert rows[1] is None and rows[2] == "" and "[email]" in rows[None] and len(rows[7]) == 200_000
    assert pii.redact(empty).count() == 0


def test_hostile_lengths_stay_fast(field):
    for text in ("1 " * 30_000, "1." * 30_000, "+1" * 30_000, "a@" * 30_000, "password" * 10_000, "x=" * 30_000, '="' * 30_000):
        pii.spans(text, field)
        secrets.spans(text)
