"""Personal data: fixed patterns, and a semi-Markov conditional random field over whole spans.

The field scores candidate segments of up to ``MAX_TOKENS`` tokens by features of the whole span (counts, shapes,
checksums, boundaries, cue words); dynamic programming over all segmentations of a line chooses boundaries and types
together.  It is trained here, on lines whose pattern matches serve as labels, with variants of them rewritten in
other spellings, so that it also finds what the patterns miss.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from math import exp, log

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgrade.llm.common import map_rows

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
#: Documents, of at most so many characters, that the field is trained on.
TRAIN_DOCUMENTS = 300
TRAIN_CHARS = 20_000
MAX_TOKENS = 20
MAX_CHARS = 80
#: Added spans need this posterior margin (log-odds) over leaving the tokens outside.
MARGIN = 2.0

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    out, last = [], 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            last = m.end()
    return out


def ips(text: str) -> list[tuple[int, int]]:
    out = []
    for m in DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        at = m.start()
        parts = m[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches of the fixed patterns that pass their test, by kind, then start."""
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    if "." in text:
        found += [("ip", *s) for s in ips(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = only_digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(only_digits(m[0])) <= 15]
    return found


# ---- the field

ANCHOR = re.compile(r"[0-9@]|[\[(<{]\s?at\s?[\])>}]|\bAT\b")
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s|[^A-Za-z0-9\s]")
LINK = re.compile(r"[\[(<{]\s?(?:at|dot)\s?[\])>}]|\bAT\b")
MAILBOX = re.compile(
    r"[A-Za-z0-9._%+-]+(?:\s?@\s?|\s?[\[(<{]\s?at\s?[\])>}]\s?|\sAT\s)[A-Za-z0-9-]+(?:(?:\s?\.\s?|\s?[\[(<{]\s?dot\s?[\])>}]\s?|\sDOT\s)[A-Za-z0-9-]+)+\Z"
)
GROUPS = re.compile(r"[0-9]+")
CUES = {
    "email": re.compile(r"(?i)(?:e-?mail|contact|write|mailto)\W*\Z"),
    "ip": re.compile(r"(?i)(?:\bip|address|host|server)\W*\Z"),
    "card": re.compile(r"(?i)(?:card|visa|credit|debit|konto|carte|tarjeta)\W*\Z"),
    "phone": re.compile(r"(?i)(?:phone|tel|call|mobile|cell|fax|telefon|m[óo]vil)\W*\Z"),
}
FEATURES = (
    "bias", "mailbox", "spelled", "at", "quad", "quad_high", "dots3", "digits16", "digits1619", "luhn", "fours", "plain", "plus", "parens", "nanp", "digits815",
    "digits_few", "digits_many", "letters", "mixed", "spaces", "tabs", "odd", "left_open", "right_open", "one_token", "short", "long", "date",
    *(f"cue_{k}" for k in KINDS),
)
INDEX = {f: i for i, f in enumerate(FEATURES)}


def span_features(text: str, start: int, end: int) -> list[int]:
    """Indices of the features that a candidate span has."""
    span = text[start:end]
    groups = GROUPS.findall(span)
    n = sum(map(len, groups))
    letters = sum(c.isalpha() for c in span)
    found = ["bias"]
    mail = bool(letters and MAILBOX.match(span))
    quad = len(groups) == 4 and span.count(".") == 3 and not letters
    sizes = [len(g) for g in groups]
    checks = (
        ("mailbox", mail),
        ("spelled", mail and "@" not in span),
        ("at", "@" in span),
        ("quad", quad and all(len(g) <= 3 and int(g) <= 255 for g in groups)),
        ("quad_high", quad and any(len(g) > 3 or int(g) > 255 for g in groups)),
        ("dots3", span.count(".") >= 3 and not letters and not quad),
        ("digits16", n == 16 and not letters),
        ("digits1619", 16 <= n <= 19 and not letters),
        ("luhn", 16 <= n <= 19 and not letters and luhn("".join(groups))),
        ("fours", len(sizes) >= 4 and set(sizes) == {4}),
        ("plain", len(groups) == 1 and n == len(span)),
        ("plus", span.startswith("+")),
        ("parens", "(" in span and ")" in span),
        ("nanp", sizes[-3:] == [3, 3, 4]),
        ("digits815", 8 <= n <= 15 and not letters),
        ("digits_few", n < 7 and not mail),
        ("digits_many", n > 19),
        ("letters", letters > 0 and not mail),
        ("mixed", letters > 0 and n > 0 and not mail),
        ("spaces", " " in span and not mail),
        ("tabs", "\t" in span),
        ("odd", any(c not in "+-(). @" and not c.isalnum() for c in span) and not mail),
        ("left_open", start > 0 and (text[start - 1].isalnum() or text[start - 1] in "+@._%-")),
        ("right_open", end < len(text) and (text[end].isalnum() or text[end] in "@_%-")),
        ("one_token", len(sizes) == 1 and not letters),
        ("short", end - start < 8),
        ("long", end - start > 40),
        ("date", sizes in ([4, 2, 2], [2, 2, 4], [4, 2, 2, 2, 2], [4, 2, 2, 2, 2, 2])),
    )
    found += [name for name, holds in checks if holds]
    left = text[max(0, start - 24) : start]
    found += [f"cue_{k}" for k in KINDS if CUES[k].search(left)]
    return [INDEX[f] for f in found]


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """For each end token, the starts of candidate segments with their last token: (first, end)."""
    out: list[list[tuple[int, int]]] = []
    for j in range(len(tokens)):
        last = text[tokens[j][0] : tokens[j][1]]
        mine: list[tuple[int, int]] = []
        if last[0].isalnum():
            anchored, words = False, 0
            for i in range(j, max(-1, j - MAX_TOKENS), -1):
                a, b = tokens[i]
                token = text[a:b]
                if tokens[j][1] - a > MAX_CHARS:
                    break
                if token[0].isspace() and i + 1 <= j and i > 0 and text[tokens[i - 1][0]].isspace():
                    break  # two spaces end a span
                alone = token.isalpha() and (a == 0 or text[a - 1].isspace()) and (b == len(text) or text[b].isspace())
                if alone and token not in ("AT", "DOT"):
                    words += 1
                    if words > 3 or not LINK.search(text[max(0, a - 24) : tokens[j][1]]):
                        break
                anchored = anchored or token[0].isdigit() or token == "@" or token in ("at", "AT")
                if anchored and tokens[j][1] - a >= 5 and (token[0].isalnum() or token in "+("):
                    mine.append((i, j + 1))
        out.append(mine)
    return out


def windows(text: str) -> list[tuple[int, int]]:
    """The parts of lines that can hold candidates: from 40 characters before to 40 after an anchor, merged."""
    out: list[tuple[int, int]] = []
    for m in ANCHOR.finditer(text):
        if out and m.end() <= out[-1][1] - 40:
            continue
        start = max(text.rfind("\n", max(0, m.start() - MAX_CHARS), m.start()) + 1, m.start() - MAX_CHARS, 0)
        end = text.find("\n", m.end(), m.end() + MAX_CHARS)
        end = min(len(text), m.end() + MAX_CHARS) if end < 0 else end
        if out and start <= out[-1][1] and "\n" not in text[out[-1][1] - 1 : start + 1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        elif not out or start > out[-1][1]:
            out.append((start, end))
        else:
            out.append((out[-1][1], max(end, out[-1][1])))
    return [w for w in out if w[0] < w[1]]


BLOCK = 512


class Field:
    """A trained semi-Markov field: one weight per feature and type; leaving a token outside scores 0."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights

    def segment(self, text: str) -> list[tuple[str, int, int]]:
        """The best segmentation of one window, in blocks of tokens, so that memory stays bounded."""
        tokens = [m.span() for m in TOKEN.finditer(text)]
        if not tokens:
            return []
        best = [0.0] * (len(tokens) + 1)
        back: list[tuple[int, int] | None] = [None] * (len(tokens) + 1)
        for first in range(0, len(tokens), BLOCK):
            low = max(0, first - MAX_TOKENS)
            part = tokens[low : first + BLOCK]
            options = candidates(text, part)[first - low :]
            flat = [(i + low, j + low) for mine in options for i, j in mine]
            matrix = np.zeros((len(flat), len(FEATURES)), dtype=np.float32)
            for row, (i, j) in enumerate(flat):
                matrix[row, span_features(text, tokens[i][0], tokens[j - 1][1])] = 1
            scores = matrix @ self.weights
            kinds, top = scores.argmax(1).tolist(), scores.max(1).tolist() if len(flat) else []
            row = 0
            for j, mine in enumerate(options, first + 1):
                best[j], back[j] = best[j - 1], None
                for _ in mine:
                    i = flat[row][0]
                    value = top[row] - MARGIN
                    if value > 0 and best[i] + value > best[j]:
                        best[j], back[j] = best[i] + value, (i, kinds[row])
                    row += 1
        out, j = [], len(tokens)
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                out.append((KINDS[kind], tokens[i][0], tokens[j - 1][1]))
                j = i
        return out[::-1]


def variants(text: str, gold: list[tuple[str, int, int]], rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """The same line with its entities spelled in other ways."""
    out, spans, at = "", [], 0
    for kind, start, end in sorted(gold, key=lambda s: s[1]):
        if start < at:
            continue
        span = text[start:end]
        if kind == "phone":
            digits = only_digits(span)
            sep = rng.choice("-. ")
            span = rng.choice([f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", sep.join((digits[-10:-7], digits[-7:-4], digits[-4:]))])
        elif kind == "card":
            digits, sep = only_digits(span), rng.choice("-. ")
            span = sep.join(digits[k : k + 4] for k in range(0, len(digits), 4))
        elif kind == "email":
            span = span.replace("@", rng.choice([" [at] ", " (at) ", "[at]", " @ ", " AT "]))
            if rng.random() < 0.5:
                span = span.replace(".", rng.choice([" [dot] ", " (dot) "])) if "@" not in span else span
        out += text[at:start]
        spans.append((kind, len(out), len(out) + len(span)))
        out, at = out + span, end
    return out + text[at:], spans


def train(texts: list[str], rounds: int = 6, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Weights by stochastic gradient ascent on the conditional likelihood of the segmentations."""
    rng = random.Random(5)
    examples = []
    for text in texts:
        for start, end in windows(text):
            part = text[start : min(end, start + 400)]
            gold = base_spans(part)
            examples.append((part, gold))
            if gold:
                examples.append(variants(part, gold, rng))
    rng.shuffle(examples)
    ready = [r for r in (prepare(t, g) for t, g in examples[:600]) if r]
    weights = np.zeros((len(FEATURES), len(KINDS)))
    squares = np.full_like(weights, 1e-6)
    for _ in range(rounds):
        for item in ready:
            gradient = ascent(item, weights) - decay * weights
            squares += gradient**2
            weights += rate * gradient / np.sqrt(squares)
        rng.shuffle(ready)
    return Field(weights.astype(np.float32))


def prepare(text: str, gold: list[tuple[str, int, int]]) -> tuple | None:
    tokens = [m.span() for m in TOKEN.finditer(text)]
    if not tokens:
        return None
    flat = [s for mine in candidates(text, tokens) for s in mine]
    if not flat:
        return None
    matrix = np.zeros((len(flat), len(FEATURES)))
    for row, (i, j) in enumerate(flat):
        matrix[row, span_features(text, tokens[i][0], tokens[j - 1][1])] = 1
    at = {(tokens[i][0], tokens[j - 1][1]): row for row, (i, j) in enumerate(flat)}
    true = np.zeros((len(flat), len(KINDS)))
    taken: list[tuple[int, int]] = []
    for kind, start, end in gold:
        row = at.get((start, end))
        if row is not None and not any(a < end and start < b for a, b in taken):
            true[row, KINDS.index(kind)] = 1
            taken.append((start, end))
    return matrix, flat, true, len(tokens)


def ascent(item: tuple, weights: np.ndarray) -> np.ndarray:
    """Gradient: features of the true segmentation less those expected under the field (forward-backward)."""
    matrix, flat, true, n = item
    scores = matrix @ weights
    peak = scores.max(1)
    total = (peak + np.log(np.exp(scores - peak[:, None]).sum(1))).tolist()
    ends: list[list[int]] = [[] for _ in range(n + 1)]
    starts: list[list[int]] = [[] for _ in range(n + 1)]
    for row, (i, j) in enumerate(flat):
        ends[j].append(row)
        starts[i].append(row)

    def lse(values: list[float]) -> float:
        top = max(values)
        return top + log(sum(exp(v - top) for v in values))

    ahead = [0.0] * (n + 1)
    for j in range(1, n + 1):
        ahead[j] = lse([ahead[j - 1], *(ahead[flat[r][0]] + total[r] for r in ends[j])])
    behind = [0.0] * (n + 1)
    for i in range(n - 1, -1, -1):
        behind[i] = lse([behind[i + 1], *(behind[flat[r][1]] + total[r] for r in starts[i])])
    reach = np.array([ahead[i] + behind[j] for i, j in flat]) - ahead[n]
    expected = np.exp(scores + reach[:, None])
    return matrix.T @ (true - expected)


def train_on(docs: DataFrame, documents: int = TRAIN_DOCUMENTS) -> Field:
    """A field trained on at most ``documents`` texts with digits or @, those with the smallest hashes.

    Only hashes are compared first, so that few texts travel however many tasks there are.
    """
    some = docs.where(F.col("text").rlike("[0-9]{2}|@") & (F.length("text") <= TRAIN_CHARS))
    hashed = some.select("text", F.xxhash64("doc_id", "text").alias("h"))
    cutoff = hashed.select("h").orderBy("h").limit(documents).agg(F.max("h")).first()[0]
    if cutoff is None:
        return Field(np.zeros((len(FEATURES), len(KINDS)), dtype=np.float32))
    return train(sorted(r[0] for r in hashed.where(F.col("h") <= cutoff).select("text").limit(documents).collect()))


def spans(text: str | None, field: Field) -> list[dict]:
    """Base spans, and those of the field that overlap none of them; by kind, then start."""
    if not text:
        return []
    base = base_spans(text)
    found = [(k, a, b, True) for k, a, b in base]
    ends = {kind: [s[2] for s in base if s[0] == kind] for kind in KINDS}
    starts = {kind: [s[1] for s in base if s[0] == kind] for kind in KINDS}

    def free(a: int, b: int) -> bool:
        return all((k := bisect_right(ends[x], a)) == len(ends[x]) or starts[x][k] >= b for x in KINDS)

    for start, end in windows(text):
        for kind, a, b in field.segment(text[start:end]):
            if free(a + start, b + start):
                found.append((kind, a + start, b + start, False))
    found.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
    return [{"kind": k, "start": a, "end": b, "base": x} for k, a, b, x in found]


def find_pii(docs: DataFrame, field: Field | None = None, keep: list[str] | None = None) -> DataFrame:
    """Adds ``pii``: spans of each whole ``text`` in code points, end exclusive, by kind, then start.

    Null and empty texts have none; every row gets its result, repeated ones too; other columns are not read.  On an
    empty table the field stays at zero weights and adds nothing.
    """
    field = train_on(docs) if field is None else field

    def make():
        return lambda texts: [(spans(t, field),) for t in texts]

    return map_rows(docs, ["text"], make, f"pii {SPANS}", ["doc_id"] if keep is None else keep)


def redact(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Documents with each span replaced by its kind in brackets; all columns stay, null texts stay null."""
    field = train_on(docs) if field is None else field

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for s in sorted(spans(text, field), key=lambda s: (s["start"], -s["end"])):
            if s["start"] >= at:
                out += [text[at : s["start"]], f"[{s['kind']}]"]
            at = max(at, s["end"])
        return "".join([*out, text[at:]])

    def make():
        return lambda texts: [(clean(t),) for t in texts]

    rows = map_rows(docs.select(F.struct(*docs.columns).alias("_row")), ["_row.text"], make, "_clean string", ["_row"])
    return rows.select(F.col("_row").withField("text", F.col("_clean")).alias("_row")).select("_row.*")
