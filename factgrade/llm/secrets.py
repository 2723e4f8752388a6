"""Secrets in text: fixed patterns, and literals that flow into sensitive names.

The lexer reads source and configuration syntax into pairs of a name and what it is given: assignments (``name = "x"``,
``name: x``, ``"name": 'x'``, ``name := x``, ``name => x``), elements (``<name>x</name>``), flags (``--name x``), calls
(``set_name("x")``), headers (``Authorization: Bearer x``), passwords of addresses (``scheme://user:x@host``) and indented
blocks (``name: |``).  What is given is a sum of quoted literals, names, templates and calls, of which a reading one
(``getenv("K", "x")``) stands for its key and its default.  Constants are followed (``k = "x"`` ... ``secret = k + "y"``,
``${k}``) in either order, and each literal is scored by the most sensitive name it reaches.
"""

from __future__ import annotations

import itertools
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from factgrade.llm.common import map_rows

KINDS = ("assign", "access", "hex", "literal")
SPANS = "array<struct<kind:string,start:bigint,end:bigint,name:string,score:double>>"
#: A literal is reported from this score on.
THRESHOLD = 0.5

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
HEX_TABLE = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
SIXTEEN = b"h" * 16
STEMS = ("passw", "secret", "token", "api")

OPERATOR = re.compile(r":=|=>|[!<>=]=|[:=]")
TRIPLE = ('"""', "'''")
QUOTED = re.compile(r""""((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`""")
#: A value without quotes; a sign of assignment ends it unless it is padding at the end or part of ``://``.
BARE = re.compile(r"""(?:[^\s"'`,;(){}\[\]<>=:]|:(?=//)|=++(?![^\s"'`,;(){}\[\]<>=]))+""")
REFERENCE = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")
TEMPLATE = re.compile(r"\$\{\s*([A-Za-z_][A-Za-z0-9_.]*)\s*\}|\{\{\s*([A-Za-z_][A-Za-z0-9_.]*)\s*\}\}|\$([A-Za-z_][A-Za-z0-9_]*)")
JOINED = re.compile(r"""[ \t]*\+[ \t]*(?=["'`$A-Za-z_])""")
CHAIN = re.compile(r"[ \t]*[=:](?![=/])")
SCHEME = re.compile(r"(?i)(?:bearer|basic|token|apikey)[ \t]+(?=[A-Za-z0-9+/_.=~-])")
ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.:-]*)(?:\s[^<>]*)?>\s*([^<>\s][^<>]*)</\1\s*>")
FLAG = re.compile(r"(?<![^\s\"'`(\[])--([A-Za-z][A-Za-z0-9_-]*)[ \t]+(?=[^\s-])")
CALL = re.compile(r"(?<![A-Za-z0-9_.])([A-Za-z_][A-Za-z0-9_.]*)\(\s*(?=[\"'`A-Za-z_])")
ADDRESS = re.compile(r"""://[^\s/:@"'`<>]*:([^\s/:@"'`<>{}$]+)@""")
BLOCK = re.compile(r"[|>][+-]?[0-9]?[ \t]*\r?\n")
#: Calls that are given the name of what they return.
READS = frozenset("get getenv env environ getattr fetch read load find lookup config input prompt getpass require check is has".split())
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
NAME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-")
#: How telling the words of a name are.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "jwt": 0.8, "signature": 0.5, "authorization": 0.7,
}
#: A text without any of these has no sensitive name and no address.
HINTS = ("pass", "pwd", "secret", "token", "api", "credential", "auth", "bearer", "jwt", "signature", "key", "://")
BEFORE_KEY = {"api", "access", "secret", "private", "signing", "encryption", "auth", "master", "account", "shared"}
PLACEHOLDER = re.compile(r"(?i)\A(?:x+|\*+|\.+|-+|none|null|nil|true|false|todo|changeme|example|placeholder|your[_-].*|<.*>|[0-9.]{1,7})\Z")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches of the fixed patterns that do not overlap others of their kind, by start, then kind."""
    found = []
    small = text.lower()
    if any(stem in small for stem in STEMS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if SIXTEEN in text.encode("utf-8", "surrogatepass").translate(HEX_TABLE):
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def sensitivity(name: str) -> float:
    """0 to 1: how likely a value of this name is a secret."""
    parts = [p.lower() for p in PARTS.findall(name)]
    best = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    if any(a in BEFORE_KEY and b == "key" for a, b in zip(parts, parts[1:])):
        best = max(best, 0.9)
    if parts and parts[-1] in {"id", "name", "count", "length", "url", "path", "file", "type", "field"}:
        best *= 0.3
    return best


def literal_weight(value: str) -> float:
    """0 to 1: how much a literal looks like a key rather than a word, a number or a placeholder."""
    if len(value) < 6 or PLACEHOLDER.match(value) or any(c.isspace() for c in value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(map(bool, (re.search("[a-z]", value), re.search("[A-Z]", value), re.search("[0-9]", value), re.search("[^A-Za-z0-9]", value))))
    return min(1.0, 0.2 + 0.12 * entropy + 0.12 * (classes - 1) + (0.1 if n >= 12 else 0.0))


@dataclass
class Given:
    """What a name is given: literals, a bare word that is one unless it names something, and other names."""

    literals: list[tuple[int, int]] = field(default_factory=list)
    bare: tuple[int, int] | None = None
    names: list[str] = field(default_factory=list)
    end: int = 0


class Lexer:
    """Pairs of names and what they are given, in one pass for each kind of syntax."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.last = {q: text.rfind(q) for q in TRIPLE}

    def quoted(self, at: int) -> tuple[int, int, int] | None:
        """Start and end of the literal in quotes at a place, and the place after it."""
        for q in TRIPLE:
            if self.text.startswith(q, at) and self.last[q] >= at + 3:
                close = self.text.index(q, at + 3)
                return at + 3, close, close + 3
        found = QUOTED.match(self.text, at)
        return (*found.span(found.lastindex or 1), found.end()) if found else None

    def arguments(self, at: int) -> tuple[list[tuple[int, int]], list[str], int]:
        """Literals and names among the arguments of a call or an index, and the place after the last of them."""
        literals, names = [], []
        while at < len(self.text):
            while at < len(self.text) and self.text[at] in ", \t\r\n":
                at += 1
            found = self.quoted(at)
            if found:
                literals.append(found[:2])
                at = found[2]
                continue
            bare = BARE.match(self.text, at)
            if not bare:
                break
            if REFERENCE.match(bare[0]):
                names.append(bare[0])
            at = bare.end()
            # The names of arguments, and calls within calls, are read as pairs of their own.
            if self.text[at : at + 1] in ("=", ":", "("):
                break
        return literals, names, at

    def given(self, at: int) -> Given:
        """The sum of terms at a place."""
        out, text = Given(end=at), self.text
        bare: list[tuple[int, int]] = []
        while True:
            literal, template = self.quoted(at), TEMPLATE.match(text, at)
            if literal:
                a, b, out.end = literal
                whole = TEMPLATE.fullmatch(text, a, b)
                if whole:
                    out.names.append(whole[whole.lastindex])
                    bare.append((a, b))
                else:
                    out.literals.append((a, b))
            elif template:
                out.names.append(template[template.lastindex])
                bare.append((at, template.end()))
                out.end = template.end()
            else:
                found = BARE.match(text, at)
                if not found:
                    break
                value = found[0].rstrip(".:!?")
                out.end = max(at + len(value), at)
                if text[found.end() : found.end() + 1] in ("(", "["):
                    literals, names, out.end = self.arguments(found.end() + 1)
                    reads = text[found.end()] == "[" or is_reading(found[0])
                    if reads and literals:
                        out.names.append(text[slice(*literals[0])])
                    out.literals += literals[reads:]
                    out.names += names
                elif value:
                    parts = value.split("+")
                    if all(map(REFERENCE.match, parts)):
                        out.names += parts
                    bare.append((at, out.end))
            more = JOINED.match(text, out.end)
            if not more:
                break
            at = more.end()
        if len(bare) == 1 and not out.literals:
            out.bare = bare[0]
        return out

    def block(self, at: int, indent: int) -> Given:
        """The lines after a place that are indented by more than ``indent``."""
        out = Given(end=at)
        while at < len(self.text):
            end = self.text.find("\n", at)
            end = len(self.text) if end < 0 else end
            line = self.text[at:end]
            body = line.strip()
            if body:
                deep = len(line) - len(line.lstrip())
                if deep <= indent:
                    break
                out.literals.append((at + deep, at + deep + len(body)))
            at = out.end = min(end + 1, len(self.text))
        return out

    def assignments(self) -> Iterator[tuple[str, Given]]:
        text, done = self.text, 0
        for m in OPERATOR.finditer(text):
            at = m.start()
            if at < done or len(m[0]) == 2 and m[0] not in (":=", "=>"):
                continue
            left = at
            while left > done and text[left - 1] in " \t":
                left -= 1
            while left > done and text[left - 1] in "\"'`]" and at - left < 8:
                left -= 1
            start = left
            while start > done and text[start - 1] in NAME:
                start -= 1
            name = text[start:left].strip(".-")
            if not name or not (name[0].isalpha() or name[0] == "_") or text.startswith("//", m.end()):
                continue
            right = m.end()
            while right < len(text) and text[right] in " \t":
                right += 1
            opened = BLOCK.match(text, right) if m[0] == ":" else None
            scheme = SCHEME.match(text, right) if "auth" in name.lower() else None
            if opened:
                line = text.rfind("\n", 0, start) + 1
                given = self.block(opened.end(), len(text[line:start]) - len(text[line:start].lstrip()))
            else:
                given = self.given(scheme.end() if scheme else right)
            # A chain such as a = b = c goes on at its next sign.
            done = right if given.bare and CHAIN.match(text, given.end) else max(given.end, right)
            if given.literals or given.bare or given.names:
                yield name, given

    def pairs(self) -> Iterator[tuple[str, Given]]:
        """All names with what they are given."""
        text = self.text
        if "=" in text or ":" in text:
            yield from self.assignments()
        if "</" in text:
            for m in ELEMENT.finditer(text):
                a, b = m.span(2)
                yield m[1].rpartition(":")[2], Given(bare=(a, a + len(text[a:b].rstrip())), names=[text[a:b].strip()])
        if "--" in text:
            for m in FLAG.finditer(text):
                yield m[1], self.given(m.end())
        if "(" in text:
            for m in CALL.finditer(text):
                if sensitivity(m[1]) and not is_reading(m[1]):
                    literals, names, _ = self.arguments(m.end())
                    yield m[1], Given(literals, names=names)
        if "://" in text:
            for m in ADDRESS.finditer(text):
                yield "password", Given(literals=[m.span(1)])


def is_reading(callee: str) -> bool:
    parts = [p.lower() for p in PARTS.findall(callee.rpartition(".")[2])]
    return bool(parts) and (parts[0] in READS or parts[-1] in READS)


def flowing_literals(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float]]:
    """Literals that reach a sensitive name: start, end, that name and the score.

    Names go from the most sensitive one down, so that each name is followed once and the work grows with the text.
    """
    small = text.lower()
    if not any(hint in small for hint in HINTS):
        return []
    found = list(Lexer(text).pairs())
    defined: dict[str, list[int]] = {}
    for k, (name, _) in enumerate(found):
        defined.setdefault(name, []).append(k)
    weights = {name: sensitivity(name) for name in defined}
    best: dict[tuple[int, int], tuple[float, str]] = {}
    reached, followed = set(), set()
    sources = [k for k, (name, _) in enumerate(found) if weights[name] >= threshold]
    for first in sorted(sources, key=lambda k: -weights[found[k][0]]):
        name, todo = found[first][0], [first]
        while todo:
            k = todo.pop()
            if k in reached:
                continue
            reached.add(k)
            own, given = found[k]
            known = [r for r in given.names if r in defined and r != own]
            for r in known:
                if r not in followed:
                    followed.add(r)
                    todo += defined[r]
            for span in given.literals if known or not given.bare else [given.bare, *given.literals]:
                score = weights[name] * literal_weight(text[slice(*span)])
                if score >= threshold and score > best.get(span, (0.0, ""))[0]:
                    best[span] = (score, name)
    return [(a, b, name, score) for (a, b), (score, name) in sorted(best.items())]


def spans(text: str | None, threshold: float = THRESHOLD) -> list[dict]:
    """All spans of a text; added literals that lie within a base span are not repeated."""
    if not text:
        return []
    base = base_spans(text)
    out = [{"kind": k, "start": a, "end": b, "name": None, "score": 1.0} for k, a, b in base]
    starts, furthest = [a for _, a, _ in base], list(itertools.accumulate((b for _, _, b in base), max))
    for a, b, name, score in flowing_literals(text, threshold):
        before = bisect_right(starts, a)
        if not before or furthest[before - 1] < b:
            out.append({"kind": "literal", "start": a, "end": b, "name": name, "score": score})
    return sorted(out, key=lambda s: (s["start"], KINDS.index(s["kind"])))


def find_secrets(docs: DataFrame, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Adds ``secrets``: spans of each whole ``text`` in code points, end exclusive, by start, then kind.

    Null and empty texts have none; every row gets its result, repeated ones too; other columns are not read.
    """

    def make():
        return lambda texts: [(spans(t, threshold),) for t in texts]

    return map_rows(docs, ["text"], make, f"secrets {SPANS}", ["doc_id"] if keep is None else keep)
