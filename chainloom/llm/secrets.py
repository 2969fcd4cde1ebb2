"""Secret scan by assignment-aware lexing.

Three patterns give the base findings. Beyond them every assignment sign of a text is parsed: the target name before
it (plain, dotted, quoted, indexed, annotated, an option or an element) and the value behind it (string literals, bare
words of configuration files, block scalars, names, calls, sums of these). That gives name-literal pairs; constants are
propagated through names, sums and interpolations, so a literal is scored by every name it reaches. The score is the
product of how sensitive the words of the name are and how much the whole value looks like a credential. Literals that
score enough and lie in no base finding are findings of the kind ``literal``.

A name stands for its last assignment before the place of use, or else its first one. Scopes are not followed.

Edge cases: null and empty texts have no findings. Unclosed quotes end with their line. A name that is defined by
itself stops there. Rows that repeat an id are scanned each; a null id stays null. Other columns are ignored, an empty
table gives no rows. Whole texts are scanned, in time that grows with their length.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The base patterns, the least length of what counts, and the order of the kinds.
ASSIGN = re.compile(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "literal")

# Words of names, how sensitive they are, and words that tell of something about a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pwd": 1.0, "secret": 1.0, "secrets": 1.0,
    "apikey": 1.0, "token": 0.9, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "pass": 0.8,
    "auth": 0.6, "authorization": 0.6, "pin": 0.5, "key": 0.5, "salt": 0.5, "signature": 0.5, "cert": 0.5,
}
KEY_WORDS = {"api": 1.0, "access": 0.9, "private": 1.0, "secret": 1.0, "signing": 0.9, "encryption": 0.9, "master": 0.9, "account": 0.8, "shared": 0.8}
ABOUT = {
    "file", "path", "dir", "url", "uri", "name", "id", "length", "len", "count", "type", "policy", "hint", "regex", "pattern",
    "label", "field", "prompt", "min", "max", "ttl", "expiry", "expires", "format", "env", "header", "column", "public",
}
PLACEHOLDER = re.compile(
    r"(?i)^(?:<.*>|\{\{.*\}\}|\$\{.*\}|%\(.*\)s|x+|\*+|\.+|change.?me.*|your[-_ ].*|example.*|dummy.*|placeholder.*|redacted.*|todo.*"
    r"|true|false|none|null|nil|undefined|required|optional|string|str|bytes)$"
)
REPORTED = 0.45
#: A value ends where brackets are nested deeper; what lies inside is parsed at its own signs.
DEEPEST = 8

_SIGN = re.compile(r":=|=>|={1,3}|:{1,2}|(?<![\w-])--(?=[A-Za-z])|</")
_NAME_BEFORE = re.compile(r"[A-Za-z_$@][\w$@.\-]*\Z")
_OPTION = re.compile(r"--([A-Za-z][\w-]*)[ \t]+(?=[^\s\-=])")
_ELEMENT = re.compile(r"</([A-Za-z_][\w.:-]*)\s*>")
_STRING = re.compile(
    r"[rRbBuUfF]{0,2}(?:\"\"\"(?P<t>[^\"\\]*(?:(?:\\.|\"(?!\"\"))[^\"\\]*)*)\"\"\"|'''(?P<s>[^'\\]*(?:(?:\\.|'(?!''))[^'\\]*)*)'''"
    r"|\"(?P<d>[^\"\\\n]*(?:\\.[^\"\\\n]*)*)\"?|'(?P<a>[^'\\\n]*(?:\\.[^'\\\n]*)*)'?|`(?P<b>[^`\\]*(?:\\.[^`\\]*)*)`)",
    re.DOTALL,
)
_BARE = re.compile(r"[^\s\"'`,;#<>(){}\[\]|&]+")
_IDENTIFIER = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*\Z")
_BLOCK_SCALAR = re.compile(r"[ \t]*[|>][+-]?[0-9]?[ \t]*\n(?P<body>(?:(?P<in>[ \t]+)\S[^\n]*(?:\n|\Z))(?:(?:(?P=in)[^\n]*|[ \t]*)(?:\n|\Z))*)")
_ANNOTATED = re.compile(r"[ \t]*[A-Za-z_][\w.]*(?:\[[\w., |\[\]]*\])?[ \t]*(?==(?!=))")
_INSIDE = re.compile(r"\$\{?([A-Za-z_]\w*)\}?|\{([A-Za-z_]\w*)\}")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    """How sensitive a name is, from its words: 0 to 1."""
    words = [w.lower() for w in _WORDS.findall(name)]
    score = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    for before, word in zip(words, words[1:], strict=False):
        if word in ("key", "keys"):
            score = max(score, KEY_WORDS.get(before, 0.0))
    return score * 0.3 if score and words[-1] in ABOUT else score


def value_score(value: str, quoted: bool) -> float:
    """How much a value looks like a credential: 0 to 1."""
    value = value.strip()
    if len(value) < 6 or PLACEHOLDER.match(value) or len(set(value)) < 4:
        return 0.0
    if _IDENTIFIER.match(value) and ("_" in value or "." in value) and not any(c.isdigit() for c in value):
        return 0.0  # a name, such as that of an environment variable
    if len(value.split()) > 2 and not value.startswith("-----BEGIN"):
        return 0.2
    kinds = sum((any(c.islower() for c in value), any(c.isupper() for c in value), any(c.isdigit() for c in value), not value.isalnum()))
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    return min(1.0, (0.45 if quoted else 0.2) + 0.12 * (kinds - 1) + 0.05 * max(0.0, entropy - 2) + min(n, 40) / 100)


@dataclass
class Part:
    """A piece of a value: literal text at a place, or a name."""

    start: int
    end: int
    text: str
    name: bool = False
    quoted: bool = False


@dataclass
class Binding:
    """A name and the alternatives it may stand for, each a sum of parts."""

    at: int
    name: str
    values: list[list[Part]]


def _string_parts(m: re.Match) -> list[Part]:
    """A string literal, cut at the names interpolated into it."""
    group = next(g for g in "tsdab" if m.group(g) is not None)
    start, end = m.span(group)
    text, head = m.group(group), m.group()[: start - m.start()].lower()
    if "$" not in text and not ("f" in head and "{" in text):
        return [Part(start, end, text, quoted=True)]
    parts, at = [], 0
    for hole in _INSIDE.finditer(text):
        if hole.group(2) and "f" not in head:
            continue
        if hole.start() > at:
            parts.append(Part(start + at, start + hole.start(), text[at : hole.start()], quoted=True))
        parts.append(Part(start + hole.start(), start + hole.end(), hole.group(1) or hole.group(2), name=True))
        at = hole.end()
    if at < len(text):
        parts.append(Part(start + at, end, text[at:], quoted=True))
    return parts


def _spaces(text: str, at: int, lines: bool) -> int:
    while at < len(text) and (text[at] in " \t" or lines and text[at] in "\r\n"):
        at += 1
    return at


def parse_value(text: str, at: int) -> tuple[list[list[Part]], int]:
    """The alternatives of the value that starts at ``at``, and where it ends.

    Strings beside each other or joined by ``+`` or ``.`` are one sum; what stands in the brackets of a call or a list
    gives one alternative each.
    """
    values: list[list[Part]] = []
    total: list[Part] = []
    depth, joined = 0, True
    while True:
        at = _spaces(text, at, depth > 0)
        c = text[at : at + 1]
        if not c:
            break
        string = _STRING.match(text, at)
        if string and string.end() > at:
            total += _string_parts(string)
            at, joined = string.end(), False
        elif c in "+.\\":
            step = _spaces(text, at + 1, True) if c in "+\\" else at + 1
            at, joined = step, True
        elif c in "([":
            if total and not joined and total[-1].name is False:
                break
            if total and total[-1].name:
                total.pop()  # the name of a call is no value
            depth, at, joined = depth + 1, at + 1, True
            if depth > DEEPEST:
                break
        elif c in ")]" and depth:
            depth, at, joined = depth - 1, at + 1, False
        elif c == "," and depth:
            values.append(total)
            total, at, joined = [], at + 1, True
        elif c in "{};,#)]>|&" or c == "<" or not joined:
            break
        else:
            word = _BARE.match(text, at)
            if not word:
                break
            body = word.group()
            if depth and "=" in body:  # a keyword argument is an assignment of its own
                body = body[: body.index("=") + 1]
                at, joined = at + len(body), True
                continue
            total.append(Part(at, at + len(body), body, name=bool(_IDENTIFIER.match(body))))
            at, joined = at + len(body), False
    values.append(total)
    return [v for v in values if v], at


def _name_before(text: str, at: int) -> str:
    """The target of an assignment sign at ``at``: a word, maybe quoted, maybe the index of something."""
    while at and text[at - 1] in " \t":
        at -= 1
    if at and text[at - 1] == "]":
        at -= 1
    if at and text[at - 1] in "\"'`":
        at -= 1
    width = 64
    while True:
        low = max(0, at - width)
        hit = _NAME_BEFORE.search(text[low:at])
        if not hit:
            return ""
        if hit.start() or not low:
            return hit.group()
        width *= 4  # the name may be longer than what was looked at


def bindings(text: str) -> list[Binding]:
    """All name-value pairs of a text, in order."""
    found: list[Binding] = []
    annotated: dict[int, str] = {}
    closed = 0
    for sign in _SIGN.finditer(text):
        mark, at, end = sign.group(), sign.start(), sign.end()
        if mark == "--":
            option = _OPTION.match(text, at)
            if option:
                found.append(Binding(at, option.group(1), parse_value(text, option.end())[0]))
        elif mark == "</":
            element = _ELEMENT.match(text, at)
            opening = text.rfind(">", closed, at) + 1
            closed = at
            if element and opening and text.endswith(f"<{element.group(1)}>", 0, opening):
                found.append(Binding(at, element.group(1), [[Part(opening, at, text[opening:at], quoted=True)]]))
        elif mark in ("=", ":", ":=", "=>"):
            name = annotated.pop(at, "") or _name_before(text, at)
            if not name:
                continue
            if mark == ":":
                kind = _ANNOTATED.match(text, end)
                if kind:
                    annotated[kind.end()] = name
                    continue
                block = _BLOCK_SCALAR.match(text, end)
                if block:
                    found.append(Binding(at, name, [[Part(*block.span("body"), block.group("body"), quoted=True)]]))
                    continue
            values = parse_value(text, end)[0]
            if values:
                found.append(Binding(at, name, values))
    return found


def _same_name(name: str) -> str:
    """How a name is known to those who use it: without the object it belongs to."""
    return name.rsplit(".", 1)[-1].lstrip("$@-")


class _Constants:
    """What names of a text stand for."""

    def __init__(self, found: list[Binding]):
        self.by_name: dict[str, list[Binding]] = defaultdict(list)
        for b in found:
            self.by_name[_same_name(b.name)].append(b)

    def before(self, name: str, at: int) -> Binding | None:
        known = self.by_name.get(_same_name(name))
        if not known:
            return None
        i = bisect_left(known, at, key=lambda b: b.at)
        return known[i - 1] if i else known[0] if known[0].at > at else None

    def literals(self, parts: list[Part], at: int) -> list[Part]:
        """The literals of a sum with names replaced, first alternative each; a name in its own definition stops."""
        out: list[Part] = []
        open_, seen = [(p, at) for p in reversed(parts)], set()
        while open_:
            part, place = open_.pop()
            if not part.name:
                out.append(part)
                continue
            binding = self.before(part.text, place)
            if binding is None:
                out.append(part)  # a bare word
            elif id(binding) not in seen:
                seen.add(id(binding))
                open_ += [(p, binding.at) for p in reversed(binding.values[0])]
        return out


def literal_findings(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, name, score) of the literals that reach a sensitive name; the best name of each."""
    found = bindings(text)
    sensitive = [(b, s) for b in found if (s := name_score(b.name)) > 0]
    if not sensitive:
        return []
    constants, best = _Constants(found), {}
    for binding, weight in sensitive:
        for value in binding.values:
            parts = constants.literals(value, binding.at)
            whole = "".join(p.text for p in parts)
            score = weight * value_score(whole, any(p.quoted for p in parts))
            if score < REPORTED:
                continue
            for p in parts:
                if p.text.strip() and best.get((p.start, p.end), ("", 0.0))[1] < score:
                    best[p.start, p.end] = (binding.name, score)
    return sorted((a, b, name, score) for (a, b), (name, score) in best.items())


def findings(text: str | None) -> list[tuple[str, int, int, str | None, float]]:
    """(kind, start, end, name, score) in code points, by start and kind; base findings score 1."""
    if not text:
        return []
    out = []
    signs = ":" in text or "=" in text
    if signs:
        out += [("assign", m.start(), m.end(), m.group(1), 1.0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), None, 1.0) for m in ACCESS.finditer(text) if len(m.group()) >= LEAST_ACCESS]
    out += [("hex", m.start(), m.end(), None, 1.0) for m in HEX.finditer(text)]
    if signs or "--" in text or "</" in text:
        found = literal_findings(text)
        covered = sorted((a, b) for _, a, b, _, _ in out)
        reach, ends = 0, []
        for _, b in covered:
            reach = max(reach, b)
            ends.append(reach)
        for a, b, name, score in found:
            i = bisect_left(covered, (a + 1,)) - 1
            if i < 0 or ends[i] < b:
                out.append(("literal", a, b, name, round(score, 6)))
    return sorted(out, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


FOUND = "doc_id bigint, findings array<struct<kind: string, start: bigint, stop: bigint, name: string, score: double>>"
_STRUCT = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("name", pa.string()), ("score", pa.float64())])
)


def _scan(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    names = ("kind", "start", "stop", "name", "score")
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            found = [[dict(zip(names, f, strict=True)) for f in findings(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _STRUCT)], names=["doc_id", "findings"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the findings of every document, in order."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_scan, FOUND)
