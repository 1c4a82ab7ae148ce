"""Finds secrets by base patterns and by reading assignments.

Source and configuration syntax in a text is lexed into pairs of a name and a literal. A literal that
is passed on through other names (constants, references) counts for each of them. The literal's score
is how sensitive the names it is given to are, times how much the literal looks like a secret.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from vitrine.llm.arrays import map_texts

KINDS = ("assign", "access", "hex", "lexed")
LEAST_SCORE = 0.5

_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # a shorter run is a failing match

# fixed values: parts of names and how sensitive they are
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "credential": 1.0,
    "credentials": 1.0, "apikey": 1.0, "token": 0.9, "bearer": 0.9, "pass": 0.8, "auth": 0.7,
    "authorization": 0.7, "signature": 0.6, "salt": 0.6, "pin": 0.6, "key": 0.4,
}
# fixed values: parts that make a "key" sensitive
KEY_OWNERS = {"api", "access", "private", "secret", "signing", "encryption", "auth", "service", "account", "master", "client"}
# fixed values: literals that stand for a secret without being one
PLACEHOLDER = re.compile(
    r"(?i)^(?:null|none|nil|true|false|undefined|changeme|change_me|example|sample|test|dummy|placeholder"
    r"|password|secret|token|your[_-].*|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|(.)\1*)$"
)

# A head is a name and the sign that gives it something; what it gets is read where the head ends. Heads are
# looked for inside values too, so a connection string or a logged line is read like any other text.
_HEAD = re.compile(
    r"""(?<![\w.$-])(?:--)?(?P<quote>\\?["']?)(?P<name>[A-Za-z_$][\w.$-]*+)(?P=quote)(?:\[["'](?P<sub>[\w.-]++)["']\])?"""
    r"""[ \t]*+(?P<sign>:=|=>|\?=|\+=|=(?!=)|:(?!:))[ \t]*+"""
)
_DEFINE = re.compile(r"^[ \t]*+#[ \t]*+define[ \t]++(?P<name>\w++)[ \t]++", re.MULTILINE)
_CALL = re.compile(r"""\b(?:set(?P<setter>[A-Z]\w*+)\(|\w++\(\s*+["'](?P<key>[\w.-]++)["']\s*+,)\s*+""")
_ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.-]*+)>(?P<bare>[^<>\s]++)</(?P=name)>")
_TAG = re.compile(r"<[A-Za-z][^<>]*+>")
_ATTRIBUTE = re.compile(r"""([\w.:-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)')""")
# a declared type between a name and its value; it ends before anything that could be a head of its own
_TYPE = re.compile(r"""[&*]?[A-Za-z_][\w.]*+(?:[<\[][^=\n"':<\[>\]]*+)*+[>\]]*+\??[ \t]*+=(?![=>])[ \t]*+""")
_BLOCK = re.compile(r"[|>][+-]?\d?[ \t]*+\n")
_LINE = re.compile(r"([ \t]*+)([^\n]*+)(?:\n|\Z)")
_QUOTED = re.compile(r"""(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`|\\"([^"\\\n]*+)\\")""")
_PLUS = re.compile(r"""\s*+(?:\+|\.\.?|\|\||&)\s*+(?=["'`])""")
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]++""")
_PIECE_END = re.compile(r"[&?]")
_REFERENCE = re.compile(r"^\$?\{?([A-Za-z_$][\w.$-]*+)\}?$")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


class Span(NamedTuple):
    start: int
    order: int
    end: int


def base_spans(text: str) -> list[Span]:
    found = [Span(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    found += [Span(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [Span(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


class Value(NamedTuple):
    start: int
    end: int
    literal: str  # joined, where it is written in parts
    quoted: bool


class Pair(NamedTuple):
    name: str
    value: Value

    @property
    def literal(self) -> str:
        return self.value.literal


class _Lexer:
    """Reads the values of heads. Every character is read a bounded number of times."""

    def __init__(self, text: str):
        self.text = text
        self.run = (0, 0)  # the last run of bare characters
        self.unclosed = {sign * 3: len(text) for sign in "\"'"}  # from here on three quotes are not closed

    def quoted(self, at: int) -> Value | None:
        """A string with its escapes, also in three quotes, or several of them that are joined."""
        text, parts, first, last = self.text, [], -1, -1
        while True:
            sign = text[at : at + 3]
            if sign in self.unclosed and at < self.unclosed[sign]:
                close = text.find(sign, at + 3)
                if close < 0:
                    self.unclosed[sign] = at
                    break
                start, end, after = at + 3, close, close + 3
            else:
                m = _QUOTED.match(text, at)
                if not m:
                    break
                (start, end), after = m.span(m.lastindex), m.end()
            first, last = start if first < 0 else first, end
            parts.append(text[start:end])
            more = _PLUS.match(text, after)
            if not more:
                break
            at = more.end()
        return Value(first, last, "".join(parts), True) if parts else None

    def bare_run(self, at: int) -> tuple[int, int]:
        """The run of bare characters around a place, from where it was first read."""
        if not self.run[0] <= at < self.run[1]:
            m = _BARE.match(self.text, at)
            self.run = m.span() if m else (at, at)
        return self.run

    def block(self, head: int, at: int) -> list[Value]:
        """The lines of a block scalar: those indented deeper than the line of its name."""
        text = self.text
        begin = text.rfind("\n", 0, head) + 1
        indent = len(_LINE.match(text, begin)[1])
        found = []
        while at < len(text):
            m = _LINE.match(text, at)
            if m[2].strip() and len(m[1]) <= indent:
                break
            if m[2].strip():
                literal = m[2].rstrip()
                found.append(Value(m.start(2), m.start(2) + len(literal), literal, True))
            at = m.end()
        return found


def lex(text: str) -> list[Pair]:
    """Name-literal pairs in the order of the text."""
    reader = _Lexer(text)
    heads = [(m.start("name"), m.end(), m["sub"] or m["name"], m["sign"]) for m in _HEAD.finditer(text)]
    heads += [(m.start("name"), m.end(), m["name"], "") for m in _DEFINE.finditer(text)]
    heads += [(m.start(), m.end(), m["setter"] or m["key"], "(") for m in _CALL.finditer(text)]
    heads.sort()
    values: list[list[Value]] = [[] for _ in heads]
    later: list[int] = []  # heads whose value waits for the next one's
    piece = -1  # the end of the piece of a bare run whose first head has been read
    for i, (start, at, name, sign) in enumerate(heads):
        if sign == ":":
            block = _BLOCK.match(text, at)
            if block:
                values[i] = reader.block(start, block.end()) if name_score(name) else []
                continue
            typed = _TYPE.match(text, at)
            at = typed.end() if typed else at
        value = reader.quoted(at)
        if value:
            values[i] = [value]
            continue
        run_start, run_end = reader.bare_run(at)
        if run_end <= at:
            continue
        following = heads[i + 1] if i + 1 < len(heads) else None
        if following and following[0] == at and following[1] >= run_end:
            later.append(i)  # name: name = value
            continue
        if at < piece:  # not the first head of its piece: up to the next one
            if following and following[0] == at:
                later.append(i)
                continue
            end = min(piece, following[0]) if following else piece
        else:
            cut = _PIECE_END.search(text, at, run_end)
            piece = cut.start() if cut else run_end
            end = run_end if run_start == at else piece  # the first of a run has all of it
        if end > at:
            values[i] = [Value(at, end, text[at:end], False)]
    for i in reversed(later):
        values[i] = values[i + 1]
    pairs = [Pair(name, v) for (_, _, name, _), own in zip(heads, values, strict=True) for v in own]
    for m in _ELEMENT.finditer(text):
        pairs.append(Pair(m["name"], Value(*m.span("bare"), m["bare"], False)))
    for m in _TAG.finditer(text):
        pairs += _attribute_pairs(text, m.start(), m.end())
    return sorted(pairs, key=lambda p: p.value.start)


def _attribute_pairs(text: str, start: int, end: int) -> list[Pair]:
    """<add key="name" value="literal"/>"""
    name, value = None, None
    for m in _ATTRIBUTE.finditer(text, start, end):
        which = m[1].lower()
        if which in ("key", "name", "id", "property"):
            name = name or m[2] or m[3]
        elif which in ("value", "content") and value is None:
            group = 2 if m[2] is not None else 3
            value = Value(*m.span(group), m[group], True)
    return [Pair(name, value)] if name and value else []


@lru_cache(maxsize=1 << 16)
def name_score(name: str) -> float:
    """How sensitive a name is, by its parts: 0 to 1."""
    parts = [p.lower() for p in _PART.findall(name)]
    best = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    if "key" in parts and KEY_OWNERS & set(parts):
        best = 1.0
    return best


def literal_score(literal: str) -> float:
    """How much a literal looks like a secret: 0 to 1."""
    if len(literal) < 8 or any(c.isspace() for c in literal) or PLACEHOLDER.match(literal):
        return 0.0
    n = len(literal)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(literal).values())
    classes = sum(map(bool, (re.search("[a-z]", literal), re.search("[A-Z]", literal), re.search("[0-9]", literal), re.search("[^A-Za-z0-9]", literal))))
    return min(1.0, entropy / 4 + 0.15 * (classes - 1))


class _Constants:
    """What names stand for: the last value before a place, else the first one after it, through other names."""

    def __init__(self, pairs: list[Pair]):
        self.first: dict[str, Pair] = {}
        for p in pairs:
            self.first.setdefault(p.name, p)
        self.before: dict[str, Value] = {}
        self.known: dict[str, Value] = {}

    def value(self, pair: Pair) -> Value:
        target = _target(pair)
        if target is None:
            return pair.value
        return self.before.get(target) or self.after(target) or pair.value

    def after(self, name: str) -> Value | None:
        """Follows names to a literal. What is found is kept for all names on the way; a ring has none."""
        way: dict[str, None] = {}
        while name not in self.known:
            if name in way or name not in self.first:
                return None
            way[name] = None
            pair = self.first[name]
            target = _target(pair)
            if target is None or target not in self.first:
                self.known[name] = pair.value
            else:
                name = target
        self.known |= dict.fromkeys(way, self.known[name])
        return self.known[name]


def _target(pair: Pair) -> str | None:
    """The name that a literal refers to, if it may be one."""
    if pair.value.quoted and not pair.literal.startswith("$"):
        return None
    m = _REFERENCE.match(pair.literal)
    return m[1] if m else None


def lexed_spans(text: str) -> list[Span]:
    """Literals that reach a sensitive name, directly or through other names."""
    if not ("=" in text or ":" in text or "</" in text or "(" in text or "#" in text):
        return []
    pairs = lex(text)
    if not any(name_score(p.name) for p in pairs):
        return []
    constants = _Constants(pairs)
    best: dict[Value, float] = {}
    for pair in pairs:
        value = constants.value(pair)
        constants.before[pair.name] = value
        sensitive = name_score(pair.name)
        if not sensitive:
            continue
        if value is pair.value and not value.quoted and not re.search("[0-9]", value.literal):
            continue  # a bare word: a name that nothing is given to, or prose
        best[value] = max(best.get(value, 0.0), sensitive)
    found: dict[int, tuple[int, float]] = {}
    for value, sensitive in best.items():
        score = sensitive * literal_score(value.literal)
        if score >= LEAST_SCORE and score > found.get(value.start, (0, 0.0))[1]:
            found[value.start] = (value.end, score)
    return [Span(start, 3, end) for start, (end, _) in found.items()]


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: lexed ones are added where no base span covers them."""
    base = base_spans(text)
    reach, covered = 0, []  # base spans by start, with the furthest end so far
    for s in base:
        reach = max(reach, s.end)
        covered.append((s.start, reach))
    added = []
    for s in lexed_spans(text):
        i = bisect.bisect_right(covered, (s.start, math.inf)) - 1
        if i < 0 or covered[i][1] < s.end:
            added.append(s)
    return base, sorted(base + added)


def joined(found: list[Span]) -> str:
    return ",".join(f"{KINDS[s.order]}:{s.start}:{s.end}" for s in found)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_lexed for every document.

    Null and empty texts have no spans. Rows are independent: repeated rows give repeated results, an
    empty table an empty one. Other columns are ignored. A long text is read whole; overlapping spans
    of different kinds are all kept.
    """

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = []
        for text in batch.column(1):
            base, both = spans(text.as_py() or "")
            counts = Counter(s.order for s in both)
            rows.append((counts[0], counts[1], counts[2], hashlib.sha256(joined(base).encode()).hexdigest(), joined(both), counts[3]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]

    fields = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_lexed long"
    return map_texts(docs, [id_col], text_col, fields, work).withColumnRenamed(id_col, "doc_id")
