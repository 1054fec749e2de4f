"""Secret scans by assignment-aware lexing.

Three plain patterns give the base findings. Beyond them a lexer reads assignments out of source and configuration
text as pairs of a name and a value: `name = "literal"`, `"name": "literal"`, `name["key"] = 'literal'`,
`export NAME=literal`, `name: literal` on a line of its own, `<name>literal</name>` and joined parts
(`"lit" + other + "eral"`). Constants are propagated: a name used as a part stands for the literals it was last given
above. A value is reported when its name speaks of secrets and the joined literals look like one; the findings are the
places of the literals themselves, also where the literal was given to a harmless name first.

Findings are (kind, start, end) in code points, end exclusive, in order of start and then kind: `assign`, `access`,
`hex`, `literal`. A literal within a base finding is not listed again.

Rows: null and empty texts have no findings. Whole texts are read, however long. Equal texts have equal findings.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column

from rankweave.llm.common import arrow_function

KINDS = ("assign", "access", "hex", "literal")
FINDINGS = "array<struct<kind:string,start:bigint,end:bigint>>"
MASK = "[REDACTED]"
# The three base patterns and their least sizes.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
# How much a word in a name speaks of secrets.
NAME_WEIGHTS = {
    "password": 3, "passwd": 3, "passphrase": 3, "passcode": 3, "pwd": 3, "pass": 3, "secret": 3, "secrets": 3,
    "token": 3, "apikey": 3, "credential": 3, "credentials": 3, "auth": 2, "authorization": 2, "bearer": 2,
    "private": 1, "access": 1, "api": 1, "signing": 1, "encryption": 1, "session": 1, "key": 2, "salt": 2,
    "signature": 1, "cookie": 1, "webhook": 1,
}
HARMLESS_NAMES = {"public", "hint", "name", "file", "path", "url", "type", "length", "size", "count", "field", "policy", "expires", "prompt", "label"}
PLACEHOLDERS = {"none", "null", "true", "false", "changeme", "example", "placeholder", "password", "secret", "token", "string", "undefined", "required", "optional", "redacted"}
SENSITIVE = re.compile("|".join(NAME_WEIGHTS), re.I | re.A)
LEAST_NAME, LEAST_TOTAL, LEAST_LITERAL = 3, 6, 6
STRIPPED = "<>[]{}$%*.x-_ "
HARMLESS = re.compile(r"\s|\$\{|\{\{|<[a-z]")
EDGE = 16  # longer than any placeholder

_STRING = r'"(?:[^"\\\n]|\\.)*"' + r"|'(?:[^'\\\n]|\\.)*'"
LEXER = re.compile(
    rf"""(?P<open><(?P<tag>[A-Za-z_][\w.-]*)>(?P<inner>[^<>\s]+)</(?P=tag)>)
      |(?<![\w.$-])(?P<quote>["']?)(?P<name>[A-Za-z_$][\w.-]*)(?P=quote)
       (?P<index>\[\s*(?:"(?:[^"\\\n]*)"|'(?:[^'\\\n]*)')\s*\])?
       [ \t]*(?P<op>:=|=>|=(?!=)|:(?![:/]))[ \t]*""",
    re.X | re.A,
)
PART = re.compile(rf"(?P<string>{_STRING})|(?P<ref>[A-Za-z_$][\w.]*)(?![\w(])", re.A)
JOINER = re.compile(r"[ \t]*(?:\+|\.\.)[ \t]*")
BARE = re.compile(r"[^\s\"'`,;()\[\]{}<>]+")
LINE_START = re.compile(r"[ \t]*(?:-[ \t]+)?(?:export[ \t]+|set[ \t]+|ENV[ \t]+|const[ \t]+|let[ \t]+|var[ \t]+)?")
AFTER_BARE = re.compile(r"[^\S\n]*(?:[#;,\n]|\Z)")
NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


@dataclass(frozen=True)
class Literal:
    text: str
    start: int
    end: int


class Value:
    """Literals joined in order, and a summary of the joined text, without masks, that is enough to score it.

    The parts are literals and other values, which are shared: a value that doubles another one costs one more node.
    `sketch` is the text shortened so that its ends, the characters between them and all short texts stay.
    """

    __slots__ = ("parts", "length", "counts", "sketch", "harmless")

    def __init__(self, parts: list[Literal | Value]):
        self.parts, self.length, self.sketch, self.harmless = parts, 0, "", False
        self.counts: Counter[str] = Counter()
        for part in parts:
            if isinstance(part, Literal):
                text = part.text.replace(MASK, "")
                length, counts, sketch, harmless = len(text), Counter(text), _shortened(text), bool(HARMLESS.search(text))
            else:
                length, counts, sketch, harmless = part.length, part.counts, part.sketch, part.harmless
            self.harmless = self.harmless or harmless or bool(HARMLESS.search(self.sketch[-1:] + sketch[:1]))
            self.length += length
            for symbol, n in counts.items():
                self.counts[symbol] += n
            self.sketch = _shortened(self.sketch + sketch)

    @property
    def text(self) -> str:
        out, left = [], [self]
        while left:
            part = left.pop()
            if isinstance(part, Literal):
                out.append(part.text)
            else:
                left.extend(reversed(part.parts))
        return "".join(out)

    def literals(self, met: set[int]) -> Iterator[Literal]:
        """The literals of this value and of its parts that are not in `met`, to which they are added."""
        left = [self]
        while left:
            part = left.pop()
            if isinstance(part, Literal):
                yield part
            elif id(part) not in met:
                met.add(id(part))
                left.extend(part.parts)


def _shortened(text: str) -> str:
    """A text that has the same ends, and the same characters before, in and after what STRIPPED leaves."""
    if len(text) <= 2 * EDGE:
        return text
    lead, tail = len(text) - len(text.lstrip(STRIPPED)), len(text.rstrip(STRIPPED))
    runs = (text[:lead], text[lead:tail], text[max(lead, tail) :])
    return "".join(x if len(x) <= 2 * EDGE else x[:EDGE] + "".join(dict.fromkeys(x[EDGE:-1])) + x[-1] for x in runs)


@dataclass(frozen=True)
class Pair:
    """A name with the literals that make its value, constants already put in."""

    name: str
    held: Value

    @property
    def value(self) -> str:
        return self.held.text


def name_score(name: str) -> int:
    words = [w.lower() for w in NAME_WORD.findall(name)]
    if not words or words[-1] in HARMLESS_NAMES:
        return 0
    return sum(NAME_WEIGHTS.get(w, 0) for w in dict.fromkeys(words))


def literal_score(value: Value) -> int:
    """How much a value looks like a secret; negative for placeholders, masks and prose."""
    bare = value.sketch.strip(STRIPPED).lower()
    if value.length < LEAST_LITERAL or bare in PLACEHOLDERS or len(set(bare)) < 4 or value.harmless:
        return -9
    symbols = "".join(value.counts)
    kinds = sum(bool(re.search(p, symbols)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    shares = [n / value.length for n in value.counts.values()]
    entropy = -sum(x * math.log2(x) for x in shares if x)  # a share may be too small for a float
    return (value.length >= 8) + (value.length >= 16) + (kinds >= 2) + (kinds >= 3) + (entropy >= 3.0) + bool(re.search("[0-9]", symbols))


def pairs(text: str) -> list[Pair]:
    """Assignments in order, with names already known replaced by their literals."""
    known: dict[str, Value] = {}
    found = []
    line, read, first = 0, 0, True
    for m in LEXER.finditer(text):
        newline = text.rfind("\n", read, m.start())
        if newline >= 0:
            line, first = newline + 1, True
        # Only the first match of a line can begin it, so a line is looked at once.
        begins, first, read = first and LINE_START.fullmatch(text, line, m.start()), False, m.start()
        if m["open"]:
            found.append(Pair(m["tag"], Value([Literal(m["inner"], *m.span("inner"))])))
            continue
        name = m["name"] + (m["index"] or "")
        value = _value(text, m.end(), known)
        if value is None and begins and (bare := BARE.match(text, m.end())) and AFTER_BARE.match(text, bare.end()):
            value = Value([Literal(bare[0], *bare.span())])
        if value:
            found.append(Pair(name, value))
            known[name] = value
    return found


def _value(text: str, at: int, known: dict[str, Value]) -> Value | None:
    """The value of an expression of strings and known names joined by + or `..`; None if it is something else."""
    parts: list[Literal | Value] = []
    while part := PART.match(text, at):
        if part["string"]:
            parts.append(Literal(part[0][1:-1], part.start() + 1, part.end() - 1))
        elif part["ref"] in known:
            parts.append(known[part["ref"]])
        else:
            break
        if not (joined := JOINER.match(text, part.end())):
            break
        at = joined.end()
    return Value(parts) if parts else None


def base_findings(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind number, end, start of the secret itself)."""
    found = []
    if ASSIGN_WORDS.search(text):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return found


def findings(text: str) -> list[tuple[int, int, int, int]]:
    """All findings in order: (start, kind number, end, start of the secret itself)."""
    found = base_findings(text)
    if ("=" in text or ":" in text or "</" in text) and SENSITIVE.search(text):
        extra, met, read = set(), set(), pairs(text)
        for pair in read:
            weight = name_score(pair.name)
            if weight >= LEAST_NAME and weight + literal_score(pair.held) >= LEAST_TOTAL:
                extra |= {(x.start, 3, x.end, x.start) for x in pair.held.literals(met) if x.end > x.start}
        found += _outside(extra, found)
    return sorted(found)


def _outside(extra: set[tuple[int, int, int, int]], base: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Those of `extra` that no base finding holds; both are read once, in order."""
    kept, held_to, i, ordered = [], -1, 0, sorted(base)
    for x in sorted(extra):
        while i < len(ordered) and ordered[i][0] <= x[0]:
            held_to = max(held_to, ordered[i][2])
            i += 1
        if x[2] > held_to:
            kept.append(x)
    return kept


def redacted(text: str) -> str:
    """The text with every secret replaced by a mask; names of assignments stay."""
    out, at = [], 0
    for start, end in sorted((inner, end) for _, _, end, inner in findings(text)):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def scan(text: Column) -> Column:
    """The findings of a text as array<struct<kind, start, end>>."""

    def make():
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

        def apply(texts: pa.Array) -> pa.Array:
            return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e, _ in findings(x or "")] for x in texts.to_pylist()], kind)

        return apply

    return arrow_function(make, FINDINGS)(text)


def redact(text: Column) -> Column:
    """The text without its secrets; null stays null."""

    def make():
        return lambda texts: pa.array([None if x is None else redacted(x) for x in texts.to_pylist()], pa.string())

    return arrow_function(make, "string")(text)
