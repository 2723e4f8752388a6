"""SQL texts that give the same rows as the named queries, for an independent engine."""

from __future__ import annotations

from factgrade import fixed

WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sents(x: str) -> str:
    marked = rf"regexp_replace({x}, '([.!?])[\s\x0b]+', '\1' || chr(1), 'g')"
    return (
        f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: trim(s, {WS})), lambda s: s <> '')"
    )


def joined(x: str) -> str:
    return f"array_to_string({x}, ' | ')"


def words(x: str) -> str:
    return rf"list_distinct(list_filter(string_split_regex(lower({x}), '[^\p{{L}}\p{{Nd}}]+'), lambda w: w <> ''))"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def one_of(*words_: str) -> str:
    return ", ".join(lit(w) for w in words_)


PAIRS_RAW = """pairs_raw AS (
  SELECT u.conv_id * 1000000 + u.turn AS row_id, u.conv_id, u.turn,
         u.text AS prompt, a.text AS response, g.text AS generated_response
  FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN conversations g ON g.conv_id = u.conv_id AND g.turn = u.turn + 3 AND g.role = 'assistant'
  WHERE u.role = 'user')"""
PAIRS = """pairs AS (
  SELECT * REPLACE (coalesce(generated_response, response) AS generated_response) FROM pairs_raw)"""
PREPARED = f"""prepared AS (
  SELECT row_id, prompt, {sents('response')} AS response_facts FROM pairs_raw)"""


def pick(values: list[str], by: str) -> str:
    return f"(ARRAY[{one_of(*values)}])[({by}) % {len(values)} + 1]"


PERSONAS = f"""personas AS (
  SELECT row_id, prompt,
    {pick(["Under 18", "18-25", "26-45", "46-65", "Over 65"], "conv_id")} AS targetAgeGroup,
    {pick(["female", "male"], "turn")} AS genderIdentity,
    {pick(["secondary", "tertiary"], "conv_id + turn")} AS educationBackground,
    {pick(["nurse", "retail", "student"], "conv_id")} AS targetProfession,
    {pick(["low", "medium", "high"], "turn")} AS digitalLiteracy,
    {pick(["England", "Scotland", "Wales", "Northern Ireland"], "conv_id")} AS geoRegion,
    {pick(["low", "medium", "high"], "conv_id + turn")} AS householdIncomeStatus,
    response
  FROM pairs_raw)"""

CLASSIFIED = """classified AS (
  SELECT doc_id,
    'LABEL_' || CASE WHEN toxic = 1 THEN doc_id % 3 WHEN quality = 1 THEN 5 ELSE 3 END AS label,
    0.90::DOUBLE + (doc_id % 10)::DOUBLE / 100 AS label_score
  FROM labels)"""


def meaning(label_id: str) -> str:
    cases = " ".join(f"WHEN {k} THEN {lit(v)}" for k, v in fixed.LABEL_MEANINGS.items())
    return f"CASE {label_id} {cases} END"


LABEL_ID = "string_split(label, '_')[-1]::BIGINT"
REFUSED = f"{LABEL_ID} NOT IN (3, 5) AND label_score >= {fixed.REFUSAL_THRESHOLD}::DOUBLE"
FLAGGED = f"""flagged AS (
  SELECT doc_id, {LABEL_ID} AS label_id, label_score, {REFUSED} AS is_abstained,
    CASE WHEN {REFUSED} THEN {meaning(LABEL_ID)} END AS abstention_type
  FROM classified)"""

MATCHED = f"""answers AS (
  SELECT doc_id, lang, source, length(text) AS char_count, {sents('text')} AS gen_facts FROM documents),
refs AS (SELECT item_id, {sents('text')} AS gt_facts FROM benchmark),
ref_facts AS (SELECT DISTINCT item_id, unnest(gt_facts) AS fact FROM refs),
claims AS (SELECT DISTINCT doc_id, unnest(gen_facts) AS fact FROM answers),
hits AS (SELECT c.doc_id, r.item_id, count(*) AS supported FROM claims c JOIN ref_facts r USING (fact) GROUP BY ALL),
chosen AS (SELECT doc_id, min(item_id) AS item_id, arg_min(supported, item_id) AS supported FROM hits GROUP BY doc_id),
matched AS (
  SELECT a.doc_id, a.lang, a.source, a.char_count, coalesce(c.item_id, -1) AS item_id, len(a.gen_facts) AS k_gen,
    coalesce(len(r.gt_facts), 0) AS k_gt, coalesce(c.supported, 0) AS supported
  FROM answers a LEFT JOIN chosen c USING (doc_id) LEFT JOIN refs r ON r.item_id = c.item_id)"""


def ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN least(1.0::DOUBLE, {part}::DOUBLE / {whole}) ELSE 0.0::DOUBLE END"


def f1(s: str, k_gen: str, k_gt: str) -> str:
    p, r = ratio(s, k_gen), ratio(s, k_gt)
    return f"CASE WHEN ({p}) + ({r}) > 0 THEN 2 * ({p}) * ({r}) / (({p}) + ({r})) ELSE 0.0::DOUBLE END"


RESULTS = f"""graded AS (
  SELECT m.doc_id, m.lang AS domain, m.source AS model, m.char_count,
    coalesce(f.is_abstained, false) AS is_abstained, f.abstention_type,
    CASE WHEN coalesce(f.is_abstained, false) THEN 0 ELSE m.supported END AS supported_claims,
    CASE WHEN coalesce(f.is_abstained, false) THEN 0 ELSE m.k_gen END AS afg_k_gen,
    m.k_gt AS afg_k_gt
  FROM matched m LEFT JOIN flagged f USING (doc_id)),
results AS (
  SELECT *, {f1('supported_claims', 'afg_k_gen', 'afg_k_gt')} AS score FROM graded)"""
ALL_RESULTS = (MATCHED, CLASSIFIED, FLAGGED, RESULTS)


def summary(by: str = "", name: str = "") -> str:
    key = f"{by} AS {name}, " if by else ""
    ans = "FILTER (WHERE NOT is_abstained)"
    q = "quantile_cont(score, {}) " + ans
    return (
        with_(*ALL_RESULTS)
        + f"""SELECT {key}count(*) AS total, count(*) FILTER (WHERE is_abstained) AS refused,
  round(100.0::DOUBLE * count(*) FILTER (WHERE is_abstained) / count(*), 6) AS refusal_percent,
  count(*) {ans} AS answered, round(avg(score), 6) AS mean_all, round(avg(score) {ans}, 6) AS mean_answered,
  round({q.format(0.5)}, 6) AS median_score, round(min(score) {ans}, 6) AS min_score,
  round(max(score) {ans}, 6) AS max_score, round(stddev_samp(score) {ans}, 6) AS sd_score,
  round({q.format(0.25)}, 6) AS q1_score, round({q.format(0.75)}, 6) AS q3_score,
  round({q.format(0.75)} - {q.format(0.25)}, 6) AS iqr_score,
  round(avg(afg_k_gen - afg_k_gt) {ans}, 6) AS mean_delta_k, round(avg(afg_k_gen) {ans}, 6) AS mean_k_gen,
  round(avg(afg_k_gt) {ans}, 6) AS mean_k_gt
FROM results"""
        + (f" GROUP BY {by}" if by else "")
    )


BM25 = f"""ex AS (SELECT item_id AS example_id, text AS sentence, string_split(text, ' ') AS t FROM benchmark),
stats AS (SELECT count(*) AS n, avg(len(t)) AS avg_len FROM ex),
post AS (SELECT example_id, len, term, count(*) AS tf
  FROM (SELECT example_id, len(t) AS len, unnest(t) AS term FROM ex) GROUP BY ALL),
raw_terms AS (SELECT term, count(*) AS df, ln(any_value(n) - count(*) + 0.5::DOUBLE) - ln(count(*) + 0.5::DOUBLE) AS idf
  FROM post, stats GROUP BY term),
floor_idf AS (SELECT {fixed.BM25_EPSILON}::DOUBLE * avg(idf) AS f FROM raw_terms),
terms AS (SELECT term, df, CASE WHEN idf < 0 THEN f ELSE idf END AS idf FROM raw_terms, floor_idf),
weights AS (SELECT p.term, p.example_id,
    idf * tf * ({fixed.BM25_K1} + 1)::DOUBLE
      / (tf + {fixed.BM25_K1}::DOUBLE * (1 - {fixed.BM25_B}::DOUBLE + {fixed.BM25_B}::DOUBLE * len / avg_len)) AS w
  FROM post p JOIN terms USING (term), stats),
asked AS (SELECT DISTINCT unnest({sents('text')}) AS sentence FROM conversations),
query AS (SELECT sentence, unnest(string_split(sentence, ' ')) AS term FROM asked),
hit AS (SELECT sentence, example_id, sum(w) AS score FROM query JOIN weights USING (term) GROUP BY ALL),
full_scores AS (SELECT a.sentence, e.example_id, round(coalesce(h.score, 0.0::DOUBLE), 6) AS score
  FROM asked a CROSS JOIN (SELECT example_id FROM ex) e LEFT JOIN hit h USING (sentence, example_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sentence ORDER BY score DESC, example_id DESC) AS rank
  FROM full_scores),
top AS (SELECT * FROM ranked WHERE rank <= {fixed.EXAMPLES_SHOWN})"""


def fill(template: str, **values: str) -> str:
    """SQL text that puts expressions into a template with named fields."""
    marked = template.format(**{k: f"\x00{k}\x00" for k in values})
    parts = marked.split("\x00")
    return " || ".join(values[p] if i % 2 else lit(p) for i, p in enumerate(parts) if p)


def dashed(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda f: '- ' || f), chr(10))"


def persona_text(row: str) -> str:
    return " || ".join(f"'{c}: ' || {row}{c} || chr(10)" for c in fixed.PERSONA_COLUMNS)


def prompt(*messages: tuple[str, str]) -> str:
    """Messages (role, SQL content) as one text."""
    return " || ".join(f"'{role.upper()}: ' || {content} || chr(10)" for role, content in messages) + " || 'ASSISTANT:'"


def digest(select: str, text: str, source: str) -> str:
    return (
        f"SELECT {select}, md5(p) AS prompt_digest, length(p) AS prompt_chars FROM (SELECT *, {text} AS p FROM {source})"
    )


NUMBERED = "array_to_string(list_transform(claims, lambda c, i: i::VARCHAR || '. ' || c), chr(10))"
STATUS_REPLY = """CASE doc_id % 8 WHEN 0 THEN 'ERROR: 429 too many requests' WHEN 1 THEN 'ERROR: Service Unavailable'
  WHEN 2 THEN 'ERROR: bad key' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN 'ERROR: request timed out' ELSE text END"""


def status(x: str) -> str:
    listed = " OR ".join(f"contains(lower({x}), {lit(w)})" for w in fixed.TEMPORARY_FAILURES)
    return (
        f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'missing' WHEN NOT starts_with({x}, {lit(fixed.FAILURE_PREFIX)})"
        f" THEN 'ok' WHEN {listed} THEN 'temporary' ELSE 'permanent' END"
    )


SUPPORTED = f"""len(list_filter(gen_facts, lambda c: len({words('c')}) > 0 AND
    len(list_intersect({words('c')}, known)) >= 0.5 * len({words('c')})))"""
TOKENS = f"""lists AS (
  SELECT row_id, prompt, generated_response, {sents('generated_response')} AS gen_facts, {sents('response')} AS gt_facts
  FROM pairs),
checked AS (
  SELECT row_id, prompt, generated_response, len(gen_facts) AS k_gen, len(gt_facts) AS k_gt, {SUPPORTED} AS supported
  FROM (SELECT *, list_distinct(flatten(list_transform(gt_facts, lambda f: {words('f')}))) AS known FROM lists))"""

LENGTH_REFUSED = """length(generated_response) % 6 NOT IN (3, 5)
  AND 0.90::DOUBLE + (length(generated_response) % 10)::DOUBLE / 100 >= 0.925::DOUBLE"""
OUTCOME = """is_abstained, CASE WHEN is_abstained THEN 'refused' ELSE 'ok' END AS status,
  s AS supported_claims, g AS k_gen, k AS k_gt"""


def outcome(ctes: tuple[str, ...], k_gen: str, k_gt: str, supported: str, source: str) -> str:
    return with_(
        PAIRS_RAW,
        PAIRS,
        *ctes,
        f"flags AS (SELECT row_id, {LENGTH_REFUSED} AS is_abstained FROM pairs)",
        f"""o AS (SELECT row_id, is_abstained, CASE WHEN is_abstained THEN 0 ELSE {supported} END AS s,
  CASE WHEN is_abstained THEN 0 ELSE {k_gen} END AS g, {k_gt} AS k FROM {source} JOIN flags USING (row_id))""",
    ) + f"SELECT row_id, {OUTCOME}, round({f1('s', 'g', 'k')}, 6) AS score FROM o"


def length_reply(n: str, patient: bool) -> str:
    ok = f"'- ' || {n} || ' characters'"
    if patient:
        return ok
    return f"CASE WHEN {n} % 11 = 0 THEN 'ERROR: 503 overloaded' WHEN {n} % 13 = 0 THEN 'ERROR: bad key' ELSE {ok} END"


ROUNDTRIP = with_(PAIRS_RAW, PAIRS) + f"""SELECT row_id, prompt, response, generated_response,
  {joined(sents('response'))} AS facts, len({sents('response')}) AS n_facts FROM pairs"""
STITCHED = f"""SELECT p.row_id, p.prompt, {joined('r.response_facts')} AS facts, len(r.response_facts) AS n_facts
FROM pairs p LEFT JOIN {{}} r USING (prompt)"""
WHOLE_DECISIONS = """'{"decisions":[' || array_to_string(list_transform(d, lambda x: '"' || x || '"'), ',') || ']}'"""
BARE_DECISIONS = """'[' || array_to_string(list_transform(d, lambda x: '"' || x || '"'), ',') || ']'"""
QUOTED_YES = "(length(upper(r)) - length(replace(upper(r), '\"YES\"', ''))) // 5"
BOX = """q AS (SELECT model, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median,
  quantile_cont(score, 0.75) AS q3 FROM results GROUP BY model),
fenced AS (SELECT r.model, r.score, q1, median, q3,
  score BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS inside FROM results r JOIN q USING (model))"""
UNION = """joint AS (
  SELECT doc_id, is_abstained, score, afg_k_gen, afg_k_gt, NULL::VARCHAR AS error FROM results
  UNION ALL SELECT doc_id, NULL, 0.0::DOUBLE, NULL, NULL, 'call failed' FROM labels WHERE quality = 0)"""

ORACLE: dict[str, str] = {
    "clean_dataset": with_(PAIRS_RAW)
    + f"""SELECT row_id, prompt, response, generated_response,
  CASE WHEN note IN ({one_of(*fixed.NULL_WORDS)}) THEN NULL ELSE note END AS note
FROM (SELECT *, (ARRAY['NA', 'None', '', 'ok', 'n/a', 'fine'])[conv_id % 6 + 1] AS note FROM pairs_raw)
WHERE prompt IS NOT NULL AND response IS NOT NULL AND generated_response IS NOT NULL""",
    "default_answer": with_(PAIRS_RAW) + "SELECT row_id, response, response AS generated_response FROM pairs_raw",
    "persona_columns": with_(PAIRS_RAW, PERSONAS) + f"SELECT {', '.join(fixed.PERSONA_COLUMNS)} FROM personas",
    "parse_facts": with_(PAIRS_RAW)
    + f"""SELECT row_id,
  CASE WHEN v = 0 OR (v = 1 AND n = 0) THEN n ELSE 0 END AS n_strict,
  CASE WHEN v = 0 THEN {joined('facts')} ELSE '' END AS strict,
  len(lenient) AS n_lenient, {joined('lenient')} AS lenient
FROM (SELECT *, CASE WHEN v = 0 THEN facts WHEN v = 4 THEN [] ELSE list_filter(list_transform(
    string_split(raw, chr(10)), lambda s: trim(s, {WS})), lambda s: s <> '') END AS lenient
  FROM (SELECT *, len(facts) AS n, CASE v WHEN 1 THEN replace(to_json(facts)::VARCHAR, '"', '''')
      WHEN 2 THEN to_json(facts)::VARCHAR || ' and more'
      WHEN 3 THEN chr(10) || '  ' || array_to_string(facts, ' ' || chr(10) || chr(10) || ' ') END AS raw
    FROM (SELECT row_id, row_id % 5 AS v, {sents('response')} AS facts FROM pairs_raw)))""",
    "truncate_text": f"""SELECT doc_id, md5(substring(coalesce(text, ''), 1, {fixed.CLASSIFIER_CHARS})) AS head_digest,
  length(substring(coalesce(text, ''), 1, {fixed.CLASSIFIER_CHARS})) AS head_chars, length(text) AS text_chars,
  CASE WHEN length(text) > 0 THEN len({sents('text')}) ELSE 0 END AS n_facts FROM documents""",
    "sentences": f"""SELECT doc_id, unnest(range(len(s))) AS sentence_no, unnest(s) AS sentence
FROM (SELECT doc_id, {sents('text')} AS s FROM documents)""",
    "atomise": with_(PAIRS_RAW, PAIRS)
    + f"""SELECT row_id, len(s) AS n_sentences, len(f) AS n_facts, {joined('f')} AS facts
FROM (SELECT row_id, s, list_filter(list_transform(s, lambda x: trim(string_split(x, chr(10))[1], {WS})),
    lambda x: x <> '') AS f0,
  list_transform(list_filter(string_split(array_to_string(list_transform(s, lambda x: ' * ' || x), chr(10)), chr(10)),
    lambda l: starts_with(trim(l, {WS}), '- ') OR starts_with(trim(l, {WS}), '* ')),
    lambda l: trim(substring(trim(l, {WS}), 3), {WS})) AS f
  FROM (SELECT row_id, {sents('generated_response')} AS s FROM pairs))""",
    "reuse_facts": with_(PAIRS_RAW)
    + f"""SELECT row_id, CASE WHEN row_id % 3 <> 0 THEN 'stored | ' || prompt
  ELSE {joined(sents('response'))} END AS facts FROM pairs_raw""",
    "stitch_facts": with_(
        PAIRS_RAW, PAIRS, PREPARED, "one AS (SELECT * FROM prepared QUALIFY row_id = min(row_id) OVER (PARTITION BY prompt))"
    )
    + STITCHED.format("one"),
    "stitch_duplicates": with_(PAIRS_RAW, PAIRS, PREPARED) + STITCHED.format("prepared"),
    "bm25_corpus": with_(BM25) + "SELECT n AS n_examples, round(avg_len, 6) AS avg_len FROM stats",
    "bm25_stats": with_(BM25) + "SELECT term, df, round(idf, 6) AS idf FROM terms",
    "bm25_top3": with_(BM25) + "SELECT sentence, rank, example_id, score FROM top",
    "atomise_prompt": with_(
        BM25,
        f"""shown AS (SELECT t.sentence, string_agg('USER: ' || {fill(fixed.SPLIT_USER, sentence='e.sentence')} || chr(10)
    || 'ASSISTANT: ' || {dashed(sents('e.sentence'))} || chr(10), '' ORDER BY t.rank) AS block
  FROM top t JOIN ex e USING (example_id) GROUP BY t.sentence)""",
    )
    + digest(
        "sentence",
        f"'SYSTEM: ' || {lit(fixed.SPLIT_SYSTEM)} || chr(10) || block || 'USER: ' || "
        f"{fill(fixed.SPLIT_USER, sentence='sentence')} || chr(10) || 'ASSISTANT:'",
        "shown",
    ),
    "persona_prompt_zero": with_(PAIRS_RAW, PERSONAS)
    + digest("row_id", prompt(("system", lit(fixed.ANSWER_SYSTEM)), ("user", persona_text(""))), "personas"),
    "persona_prompt_few": with_(
        PAIRS_RAW,
        PERSONAS,
        f"""shown AS (SELECT string_agg('USER: ' || {persona_text('')} || chr(10)
    || 'ASSISTANT: response: ' || response || chr(10) || chr(10), '' ORDER BY row_id) AS block
  FROM (SELECT * FROM personas ORDER BY row_id LIMIT {fixed.EXAMPLES_SHOWN}))""",
    )
    + digest(
        "row_id",
        f"'SYSTEM: ' || {lit(fixed.ANSWER_SYSTEM)} || chr(10) || block || 'USER: ' || {persona_text('')}"
        " || chr(10) || 'ASSISTANT:'",
        "(SELECT * FROM personas, shown)",
    ),
    "generation_tasks": with_(PAIRS_RAW)
    + """SELECT row_id, string_split(model, '/')[-1] AS model, context FROM pairs_raw,
  (VALUES ('host/model-a', 'zero'), ('host/model-a', 'few'), ('model-b', 'zero')) v(model, context)""",
    "claim_prompt": with_(PAIRS_RAW, PAIRS)
    + digest(
        "row_id, claim_no",
        prompt(
            ("system", lit(fixed.CHECK_SYSTEM)),
            ("user", fill(fixed.CHECK_USER, reference_text=dashed("refs"), claim="claim")),
        ),
        f"""(SELECT row_id, refs, unnest(range(len(s))) AS claim_no, unnest(s) AS claim FROM
  (SELECT row_id, {sents('response')} AS refs, {sents('generated_response')} AS s FROM pairs))""",
    ),
    "answer_prompt": with_(PAIRS_RAW, PAIRS)
    + digest(
        "row_id",
        prompt(("user", fill(fixed.CHECK_ALL, reference_text=dashed("refs"), claims=NUMBERED))),
        f"(SELECT row_id, {sents('response')} AS refs, {sents('generated_response')} AS claims FROM pairs)",
    ),
    "option_match": f"""SELECT conv_id, turn, option, contains(upper(option), 'YES') AS supported FROM (
  SELECT conv_id, turn, CASE WHEN lower(r) = 'yes' THEN 'YES' WHEN lower(r) = 'no' THEN 'NO'
    WHEN contains(lower(r), 'yes') THEN 'YES' WHEN contains(lower(r), 'no') THEN 'NO' WHEN r <> '' THEN r ELSE 'YES' END AS option
  FROM (SELECT conv_id, turn, trim(CASE WHEN turn % 4 = 1 THEN text WHEN conv_id % 3 = 0 THEN ' yes '
    WHEN conv_id % 3 = 1 THEN '' ELSE 'maybe' END, {WS}) AS r FROM conversations WHERE role = 'assistant'))""",
    "decisions": f"""SELECT doc_id, CASE WHEN json_valid(r) AND json_type(r) = 'OBJECT' THEN
    CASE WHEN NOT list_contains(json_keys(r), 'decisions') THEN 0
      WHEN json_type(r, '$.decisions') = 'ARRAY'
        THEN len(list_filter((r::JSON->'$.decisions')::VARCHAR[], lambda x: upper(x) = 'YES'))
      ELSE {QUOTED_YES} END
  ELSE coalesce({QUOTED_YES}, 0) END AS n_yes
FROM (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN {WHOLE_DECISIONS} WHEN 1 THEN {WHOLE_DECISIONS}
    WHEN 2 THEN {BARE_DECISIONS} WHEN 3 THEN {WHOLE_DECISIONS} || ' so'
    WHEN 4 THEN replace({WHOLE_DECISIONS}, 'decisions', 'verdicts') WHEN 5 THEN '{{"decisions": null}}' END AS r
  FROM (SELECT doc_id, list_transform({sents('text')}, lambda s:
    CASE length(s) % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'no' ELSE 'Yes' END) AS d FROM documents))""",
    "refusals": with_(CLASSIFIED, FLAGGED)
    + "SELECT doc_id, label_id, round(label_score, 6) AS label_score, is_abstained, abstention_type FROM flagged",
    "keyword_refusals": f"""SELECT conv_id, turn, f AS is_abstained, CASE WHEN f THEN {meaning('0')} END AS abstention_type
FROM (SELECT conv_id, turn, regexp_matches(lower(CASE conv_id % 4 WHEN 0 THEN 'I''m sorry, but no. '
    WHEN 1 THEN 'Was an aide. ' ELSE '' END || text), '\\b(?:{"|".join(p.replace("'", "''") for p in fixed.REFUSAL_PHRASES)})\\b') AS f
  FROM conversations WHERE role = 'assistant')""",
    "reply_status": f"SELECT doc_id, {status('r')} AS status FROM (SELECT doc_id, {STATUS_REPLY} AS r FROM documents)",
    "prompt_dedupe": f"""SELECT doc_id, md5(text) AS prompt_hash, {lit(fixed.MOCK_REPLY)} AS reply, 'ok' AS status
FROM documents""",
    "pending": f"""SELECT md5(text) AS prompt_hash, max(length({fill(fixed.SPLIT_USER, sentence='text')})) AS content_chars
FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM (SELECT text, {STATUS_REPLY} AS r FROM documents)
  WHERE {status('r')} IN ('ok', 'permanent')) GROUP BY 1""",
    "reassemble": with_(PAIRS_RAW, PAIRS) + "SELECT row_id, prompt, md5(generated_response) AS outcome FROM pairs",
    "verify_exact": with_(MATCHED) + "SELECT doc_id, item_id, k_gen, k_gt, supported FROM matched",
    "verify_tokens": with_(PAIRS_RAW, PAIRS, TOKENS)
    + f"SELECT row_id, k_gen, k_gt, supported, round({f1('supported', 'k_gen', 'k_gt')}, 6) AS score FROM checked",
    "supported_claims": with_(PAIRS_RAW, PAIRS)
    + f"""SELECT row_id, count(*) FILTER (WHERE length(claim) % 2 = 0) AS supported_claims
FROM (SELECT row_id, unnest({sents('generated_response')}) AS claim FROM pairs) GROUP BY row_id""",
    "score_f1": with_(*ALL_RESULTS)
    + f"""SELECT doc_id, supported_claims, afg_k_gen AS k_gen, afg_k_gt AS k_gt,
  round({ratio('supported_claims', 'afg_k_gen')}, 6) AS precision,
  round({ratio('supported_claims', 'afg_k_gt')}, 6) AS recall, round(score, 6) AS score FROM results""",
    "summary": summary(),
    "summary_by_lang": summary("domain", "lang"),
    "refusal_breakdown": with_(CLASSIFIED, FLAGGED)
    + "SELECT abstention_type, count(*) AS n_rows FROM flagged WHERE is_abstained GROUP BY 1 ORDER BY 2 DESC, 1",
    "derived_metrics": with_(*ALL_RESULTS)
    + f"""SELECT doc_id, replace(replace(f, {lit(fixed.RESULTS_PREFIX)}, ''), '.csv', '') AS model,
  replace(f, '.csv', {lit(fixed.READY_SUFFIX)}) AS ready_file,
  replace(f, '.csv', {lit(fixed.REFERENCE_SUFFIX)}) AS reference_file, afg_k_gen - afg_k_gt AS delta_k, char_count,
  round(char_count::DOUBLE / CASE WHEN afg_k_gen = 0 THEN 1 ELSE afg_k_gen END, 6) AS claim_density
FROM (SELECT *, {lit(fixed.RESULTS_PREFIX)} || model || '.csv' AS f FROM results)""",
    "domain_model_mean": with_(*ALL_RESULTS)
    + "SELECT domain, model, round(avg(score), 6) AS mean_score, count(score) AS n_rows FROM results GROUP BY ALL",
    "domain_model_matrix": with_(*ALL_RESULTS)
    + "SELECT domain, "
    + ", ".join(f"round(avg(score) FILTER (WHERE model = 'src{i}'), 6) AS src{i}" for i in range(20))
    + " FROM results WHERE domain IS NOT NULL GROUP BY domain",
    "boxplot": with_(*ALL_RESULTS, BOX)
    + """SELECT model, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, count(*) AS n_rows,
  round(min(score) FILTER (WHERE inside), 6) AS whisker_low, round(max(score) FILTER (WHERE inside), 6) AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS n_outliers FROM fenced GROUP BY model, fenced.q1, fenced.median, fenced.q3""",
    "outliers": with_(*ALL_RESULTS, BOX)
    + "SELECT model, round(score, 6) AS score, count(*) AS n_rows FROM fenced WHERE NOT inside GROUP BY model, fenced.score",
    "regression": with_(*ALL_RESULTS)
    + """SELECT round(regr_slope(score, afg_k_gen - afg_k_gt), 6) AS slope,
  round(regr_intercept(score, afg_k_gen - afg_k_gt), 6) AS intercept,
  round(regr_r2(score, afg_k_gen - afg_k_gt), 6) AS r2, regr_count(score, afg_k_gen - afg_k_gt)::BIGINT AS n_rows FROM results""",
    "first_n_per_source": f"""SELECT doc_id, source, lang FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= {fixed.SUBSET_ROWS}""",
    "first_n": "SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 100",
    "rows_per_source": "SELECT source, count(*) AS n_rows FROM documents GROUP BY source",
    "union_results": with_(*ALL_RESULTS, UNION)
    + "SELECT doc_id, is_abstained, round(score, 6) AS score, afg_k_gen, afg_k_gt, error FROM joint",
    "outcome_groups": with_(*ALL_RESULTS, UNION)
    + """SELECT CASE WHEN is_abstained IS NULL THEN 'failed' WHEN is_abstained THEN 'refused' ELSE 'answered' END AS outcome,
  count(*) AS n_rows, round(avg(round(score, 6)), 6) AS mean_score FROM joint GROUP BY 1""",
    "hot_prompt_join": """SELECT doc_id, lang AS prompt_hash, 'reply ' || max(doc_id) OVER (PARTITION BY lang) AS reply
FROM documents""",
    "csv_roundtrip": ROUNDTRIP,
    "json_roundtrip": ROUNDTRIP,
    "json_arrays": with_(PAIRS_RAW)
    + f"""SELECT row_id, prompt, response, response AS generated_response, {joined(sents('response'))} AS facts
FROM pairs_raw""",
    "few_shot_tables": f"""SELECT text AS sentence, {joined(sents('text'))} AS facts, len({sents('text')}) AS n_facts
FROM benchmark""",
    "folder_read": with_(PAIRS_RAW)
    + """SELECT row_id AS id, prompt, response,
  CASE WHEN row_id % 2 = 1 AND row_id % 7 <> 0 THEN round((row_id % 7)::DOUBLE / 10 + 0.25, 6) END AS score FROM pairs_raw""",
    "results_written": with_(*ALL_RESULTS)
    + "SELECT doc_id, domain, model, is_abstained, round(score, 6) AS score FROM results",
    "partitioned_write": with_(*ALL_RESULTS)
    + f"""SELECT {lit(fixed.RESULTS_PREFIX)} || model || {lit(fixed.READY_SUFFIX)} AS ready_file, count(*) AS n_rows,
  sum(supported_claims)::BIGINT AS supported_claims FROM results GROUP BY 1""",
    "reply_stage": f"""SELECT conv_id, turn, r AS reply, {status('r')} AS status
FROM (SELECT conv_id, turn, {length_reply('length(text)', False)} AS r FROM conversations)""",
    "resume_replies": f"""SELECT DISTINCT md5(text) AS content_digest,
  {status('r')} AS status, r AS reply, attempts FROM (
  SELECT text, CASE WHEN length(text) % 11 = 0 THEN 2 ELSE 1 END::BIGINT AS attempts,
    CASE WHEN length(text) % 11 = 0 THEN {length_reply('length(text)', True)}
      ELSE {length_reply('length(text)', False)} END AS r FROM conversations)""",
    "classify_stage": with_(PAIRS_RAW, PAIRS)
    + f"""SELECT row_id, 'LABEL_' || length(generated_response) % 6 AS label,
  round(0.90::DOUBLE + (length(generated_response) % 10)::DOUBLE / 100, 6) AS label_score,
  {LENGTH_REFUSED} AS is_abstained FROM pairs""",
    "prepare_offline": with_(PAIRS_RAW)
    + f"SELECT row_id, prompt, {joined(sents('response'))} AS facts, len({sents('response')}) AS n_facts FROM pairs_raw",
    "evaluate_offline": outcome(
        (
            PREPARED,
            f"""lists AS (SELECT p.row_id, p.generated_response, {sents('p.generated_response')} AS gen_facts,
    o.response_facts AS gt_facts
  FROM pairs p JOIN (SELECT * FROM prepared QUALIFY row_id = min(row_id) OVER (PARTITION BY prompt)) o USING (prompt))""",
            f"""checked AS (SELECT row_id, len(gen_facts) AS k_gen, len(gt_facts) AS k_gt, {SUPPORTED} AS supported
  FROM (SELECT *, list_distinct(flatten(list_transform(gt_facts, lambda f: {words('f')}))) AS known FROM lists))""",
        ),
        "k_gen",
        "k_gt",
        "supported",
        "checked",
    ),
    "evaluate_with_replies": outcome(
        (
            f"""lists AS (SELECT row_id, {sents('generated_response')} AS gen_facts, {sents('response')} AS gt_facts
  FROM pairs)""",
        ),
        "len(gen_facts)",
        "len(gt_facts)",
        r"""CASE WHEN len(gt_facts) = 0 THEN 0 ELSE len(list_filter(gen_facts,
    lambda c: length(regexp_replace(c, '[\s\x0b]+', ' ', 'g')) % 2 = 0)) END""",
        "lists",
    ),
    "generate_mock": with_(PAIRS_RAW)
    + f"""SELECT row_id, prompt, response, {lit(fixed.MOCK_REPLY)} AS generated_response, 'ok' AS reply_status
FROM pairs_raw""",
    "folder_stream": with_(PAIRS_RAW, PAIRS, TOKENS)
    + f"SELECT row_id, supported, round({f1('supported', 'k_gen', 'k_gt')}, 6) AS score FROM checked",
}
