"""Secret scans: fixed patterns plus assignment-aware lexing.

Patterns: ``assign`` (a sensitive name, an operator, a value of 8 or more
characters), ``access`` (key ids of 16 or more), ``hex`` (runs of 32 or more).
Lexing: texts are cut into tokens; ``=``, ``:``, ``:=`` and ``=>`` pair the name
before them (a type or array declarator between is passed over) with the
literals, names and ``+`` after them, across lines where brackets, a ``+``, an
escaped line end or a deeper indent go on. What strings hold is lexed again.
Names bound to literals are
constants of the text and are put in where a later expression uses them. A
literal is a secret (kind ``flow``) if its target's words are sensitive and its
own length, variety and shape speak for a key rather than a placeholder.

Spans are code points, end exclusive, of the whole text. Null texts are empty
and have no spans. Rows are independent: repeated rows get the same spans,
extra columns are carried along, an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowforge.llm.common import bounded_batches, text_or_empty

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "flow")

_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_NAMED = ("password", "passwd", "secret", "token", "apikey", "api_key")

_TOKEN = re.compile(r"""(?:[^\S\n]|\\\r?\n)*(?:"""
                    r"""((?:\b(?:[rRbBuUfFL]{1,2}|u8)|(?<![A-Za-z0-9_]))(?:\"{3}(?:\\.|[^\\])*?\"{3}|'{3}(?:\\.|[^\\])*?'{3}"""
                    r"""|"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'|`(?:\\.|[^`\\\n])*`))"""
                    r"""|([A-Za-z0-9_][A-Za-z0-9_.\-]*)|(:=|=>|(?:[=!<>]=+|::|->)|[:=])|(\n)|(\S))""", re.DOTALL)
#: The same for languages where a backslash before a quote is no escape.
_PLAIN_TOKEN = re.compile(_TOKEN.pattern.replace(r'(?:\\.|[^"\\\n])*', r'[^"\n]*').replace(r"(?:\\.|[^'\\\n])*", r"[^'\n]*"),
                          re.DOTALL)
STRING, WORD, OPERATOR, LINE, OTHER = range(1, 6)
_QUOTE = re.compile(r"""[A-Za-z0-9]*(\"{3}|'{3}|["'`])""")
_BARE = re.compile(r"[A-Za-z0-9_+/.=\-]+")
_ASSIGNS = (":=", "=>", ":", "=")
_TYPE_MARKS = frozenset("[]<>|,?&*()'.")
#: Type names that may stand between a name and its operator (Go, SQL).
_TYPES = ("string", "str", "text", "varchar", "char", "byte", "bytes", "object", "any")
_TERM = re.compile(r""""[^"\n]*"|'[^'\n]*'|`[^`\n]*`|[A-Za-z0-9_/.=\-]+""")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

#: How strongly a word of a target name speaks for a secret.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
             "apikey": 1.0, "credential": 0.8, "credentials": 0.8, "auth": 0.6, "bearer": 0.8, "signature": 0.5,
             "private": 0.5, "access": 0.4, "api": 0.4, "key": 0.5, "salt": 0.5}
_PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|changeme|example|none|null|true|false|your.*|todo|test|\$\{.*\}|<.*>)$")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    found = []
    low = text.lower()
    if any(name in low for name in _NAMED):
        found += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return found


def target_score(name: str) -> float:
    words = [w.lower() for w in _WORDS.findall(name)]
    return min(1.0, sum(SENSITIVE.get(w, 0.0) for w in words))


def literal_score(value: str) -> float:
    """0 for placeholders and short values, up to 1 for long varied ones."""
    if len(value) < 8 or _PLACEHOLDER.match(value):
        return 0.0
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit))
    return min(1.0, bits / 4) * (0.6 + 0.2 * min(kinds, 2)) * (0.5 if " " in value else 1.0)


class Lexed:
    """Tokens of a stretch of a text: strings with escapes (triple quotes and
    prefixes too), words, operators, line ends and other marks. Blanks and
    escaped line ends only separate."""

    def __init__(self, text: str, begin: int, end: int, token: re.Pattern = _TOKEN) -> None:
        self.text, self.kinds, self.starts, self.ends = text, bytearray(), array("q"), array("q")
        for m in token.finditer(text, begin, end):
            kind = m.lastindex
            self.kinds.append(kind)
            self.starts.append(m.start(kind))
            self.ends.append(m.end(kind))
        self.n, self.begin, self.end = len(self.kinds), begin, end

    def kind(self, i: int) -> int:
        return self.kinds[i] if 0 <= i < self.n else 0

    def word(self, i: int) -> str:
        return self.text[self.starts[i]:self.ends[i]] if 0 <= i < self.n else ""

    def content(self, i: int) -> tuple[int, int]:
        """Span of what a string's quotes hold."""
        quote = _QUOTE.match(self.text, self.starts[i])
        return quote.end(), self.ends[i] - len(quote[1])

    def indent(self, at: int) -> int:
        """Blanks before the first character of the line of ``at``."""
        start = max(self.text.rfind("\n", 0, at) + 1, self.begin)
        while start < self.end and self.text[start] == "-" and self.text[start + 1:start + 2] == " ":
            start += 2
        line = self.text[start:at]
        return len(line) - len(line.lstrip())

    def past_lines(self, i: int) -> int:
        while self.kind(i) == LINE:
            i += 1
        return i

    def target(self, i: int) -> tuple[str, str, int]:
        """Full name, plain name and start of what stands before operator i."""
        j = i - 1
        if self.word(i) == "=" and self.kind(j) == LINE:
            j -= 1
        while self.word(j) in ("?", "!") and self.kind(j) == OTHER:
            j -= 1
        last = j
        while self.word(j) == "]" and self.kind(j) == OTHER:  # subscripts and array declarators
            depth = 0
            while j >= 0 and self.kind(j) != LINE and last - j < 64:
                depth += {"]": 1, "[": -1}.get(self.word(j), 0) if self.kind(j) == OTHER else 0
                j -= 1
                if not depth:
                    break
            if depth:
                return "", "", 0
        if j == last and self.kind(j) == STRING:
            a, b = self.content(j)
            return self.text[a:b], self.text[a:b], self.starts[j]
        if self.kind(j) != WORD:
            return "", "", 0
        if j == last and self.word(j).lower() in _TYPES and self.kind(j - 1) == WORD:
            last = j = j - 1
        name = self.word(j).lstrip("0123456789.-")
        return self.text[self.starts[j]:self.ends[last]] if name else "", name, self.starts[j]

    def typed(self, i: int) -> int:
        """The ``=`` that ends the type annotation begun by ``:`` i, or 0."""
        k, depth, named = i + 1, 0, False
        while k < self.n:
            kind, word = self.kinds[k], self.word(k)
            if kind == OPERATOR and word == "=" and not depth:
                apart = self.starts[k] > self.ends[k - 1] or self.starts[k + 1] > self.ends[k] if k + 1 < self.n else False
                return k if named and (apart or self.kind(k + 1) == STRING) else 0
            if kind == WORD:
                named = True
            elif kind == OTHER and word in _TYPE_MARKS and (word != "," or depth):
                depth += (word in "[<(") - (word in "]>)")
                if depth < 0:
                    return 0
            elif not (kind == STRING and depth) and not (kind == OPERATOR and word in ("::", "->")):
                return 0
            k += 1
        return 0

    def block(self, i: int, least: int) -> tuple[list[tuple[int, int]], int]:
        """Lines after token i that are indented deeper than ``least``."""
        parts, at = [], self.text.find("\n", self.starts[i], self.end) + 1
        while 0 < at < self.end:
            stop = self.text.find("\n", at, self.end)
            stop = self.end if stop < 0 else stop
            line = self.text[at:stop]
            body = line.strip()
            if body:
                start = at + len(line) - len(line.lstrip())
                if start - at <= least:
                    break
                parts.append((start, start + len(body)))
            at = stop + 1
        return parts, parts[-1][1] if parts else 0

    def value(self, i: int, start: int, known: dict) -> tuple[list[tuple[int, int]], int]:
        """Literals of the expression after operator i, and where it ends (0:
        there is none). ``start``: where the statement's target begins."""
        k, op, opened, parts, end = i + 1, self.word(i), [], [], 0
        mark = self.word(k)
        if op == ":" and mark in ("|", ">") and self.kind(k) == OTHER:
            after = k + 1
            while self.kind(after) in (WORD, OTHER) and self.word(after) in ("-", "+", *"123456789"):
                after += 1
            if self.kind(after) == LINE:
                return self.block(k, self.indent(start))
        if self.kind(k) == LINE:
            k = self.past_lines(k)
            if k >= self.n or self.indent(self.starts[k]) <= self.indent(start) and self.kind(k) != STRING:
                return [], 0
            if self.word(k) == "-" and op == ":":
                k += 1
            if self.kind(k) in (WORD, STRING) and self.kind(k + 1) == OPERATOR and self.word(k + 1) in _ASSIGNS:
                return [], 0  # a statement of its own
        while k < self.n:
            kind, word = self.kinds[k], self.word(k)
            if kind == OTHER and word in "([{":
                opened.append(word)
            elif kind == OTHER and word in ")]}" and opened:
                opened.pop()
                if not opened and parts:
                    end = self.ends[k]
            elif kind == LINE and opened:
                pass
            elif kind == OTHER and word == "," and opened and opened[-1] != "(":
                pass
            elif kind == OTHER and word in "@&$*" and self.kind(k + 1) == STRING:
                pass
            elif kind == STRING:
                if self.kind(k + 1) == OPERATOR and self.word(k + 1) in _ASSIGNS and opened:
                    break  # a key
                parts.append(self.content(k))
                end = self.ends[k]
            elif kind == OTHER and word == "+" and parts:
                k = self.past_lines(k + 1) - 1
                if self.kind(k + 1) == WORD:
                    a, b = _BARE.match(self.text, self.starts[k + 1], self.end).span()
                    parts += known.get(self.text[a:b], [])
                    end, k = b, self.at(b, k + 1) - 1
            elif kind == LINE and parts and self.word(self.past_lines(k)) == "+":
                pass
            elif not parts and (bare := _BARE.match(self.text, self.starts[k], self.end)):
                if opened and self.kind(self.at(bare.end(), k)) == OPERATOR:
                    break
                for term in _TERM.finditer(self.text, *bare.span()):
                    parts += known.get(term[0], [term.span()])
                end = bare.end()
                k = self.at(end, k) - 1
            else:
                break
            k += 1
            if not opened and end and self.kind(k) not in (STRING, LINE) and self.word(k) != "+":
                break
        return parts, end

    def at(self, place: int, i: int) -> int:
        """The first token from i on that begins at ``place`` or later."""
        while i < self.n and self.starts[i] < place:
            i += 1
        return i


def flow_spans(text: str, least: float = 0.5) -> list[tuple[int, str, int]]:
    """Literals that reach a sensitive target, by constants as well."""
    low = text.lower()
    if not any(word in low for word in SENSITIVE):
        return []
    found = literals(text, least, _TOKEN)
    if '\\"' in text or "\\'" in text:
        # a path that ends in a backslash must not hide what follows it
        found |= apart(literals(text, least, _PLAIN_TOKEN), found)
    return [(a, "flow", b) for a, b in found]


def apart(new: set[tuple[int, int]], old: set[tuple[int, int]]) -> set[tuple[int, int]]:
    """The new spans that meet no old one."""
    spans = sorted(old)
    starts = [a for a, _ in spans]
    reach = list(accumulate((b for _, b in spans), max))  # the furthest end so far
    out = set()
    for a, b in new:
        i = bisect_left(starts, b)
        if not i or reach[i - 1] <= a:
            out.add((a, b))
    return out


def literals(text: str, least: float, token: re.Pattern) -> set[tuple[int, int]]:
    known: dict[str, list[tuple[int, int]]] = {}
    found: set[tuple[int, int]] = set()
    stretches = [(0, len(text))]
    while stretches:
        lexed = Lexed(text, *stretches.pop(), token)
        done = lexed.begin
        i = lexed.kinds.find(OPERATOR)
        while i >= 0:
            op, at = lexed.word(i), i
            if op in _ASSIGNS and not (op == ":" and text.startswith("//", lexed.ends[i])):
                full, name, start = lexed.target(i)
                if full and start >= done:
                    weight = target_score(full)
                    if op == ":" and (typed := lexed.typed(i)):
                        weight = max(weight, target_score(text[lexed.ends[i]:lexed.starts[typed]]))
                        at = typed
                    parts, end = lexed.value(at, start, known)
                    if parts:
                        done = max(done, end)
                        # a span counts once, so a name never has more than the text
                        parts = list(dict.fromkeys(parts))
                        known[full] = known[name] = parts
                        if weight and weight * literal_score("".join(text[a:b] for a, b in parts)) >= least:
                            found.update(p for p in parts if p[0] < p[1])
            i = lexed.kinds.find(OPERATOR, at + 1)
        # what strings hold can be statements as well
        i = lexed.kinds.find(STRING)
        while i >= 0:
            a, b = lexed.content(i)
            if (a, b) not in found and ("=" in text[a:b] or ":" in text[a:b]):
                stretches.append((a, b))
            i = lexed.kinds.find(STRING, i + 1)
    return found


def find_spans(text: str) -> list[tuple[int, str, int]]:
    spans = base_spans(text) + flow_spans(text)
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def redact(text: str, spans: list[tuple[int, str, int]], mark: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += (text[at:start], mark)
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with ``secrets`` (kind, start, end) and ``redacted_text``."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns
                                  if c not in ("secrets", "redacted_text")]).alias("row"), text_or_empty().alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, clean = [], []
            for text in batch.column(1).to_pylist():
                spans = find_spans(text)
                found.append([{"kind": k, "start": a, "end": b} for a, k, b in spans])
                clean.append(redact(text, spans, mark) if spans else text)
            yield pa.record_batch([batch.column(0), pa.array(found, kind), pa.array(clean, pa.string())],
                                  names=["row", "secrets", "redacted_text"])

    row_type = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(scan, f"row {row_type}, secrets array<struct<kind:string,start:bigint,end:bigint>>, "
                                 "redacted_text string").select("row.*", "secrets", "redacted_text")


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
