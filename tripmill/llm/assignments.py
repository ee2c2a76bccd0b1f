"""Secret scan by lexing assignments.

Source and configuration syntax is read into pairs of a name and what is assigned to it: string literals, bare values
and other names. Constants go along the names, so that a literal counts for every name that it reaches, and a literal
is told a secret by how sensitive the best of those names is and by what the literal itself looks like. Patterns that
need no name (access keys, hexadecimal keys, plain assignments) are found beside it.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import hold_nothing, per_text

# Patterns without a name, and how many characters they must have.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
BASE, NAMED = ["assign", "access", "hex"], "named"
KINDS = [*BASE, NAMED]

#: How sensitive words and neighbouring words of a name are, and what speaks against it.
SENSITIVE = {
    "password": 4, "passwd": 4, "passphrase": 4, "secret": 4, "apikey": 4, "api key": 4, "access key": 4, "private key": 4, "secret key": 4,
    "client secret": 4, "signing key": 4, "encryption key": 4, "auth key": 4, "account key": 4, "pwd": 3, "token": 3, "credential": 3,
    "credentials": 3, "bearer": 3, "auth": 2, "pass": 2, "pin": 1, "key": 1, "salt": 1,
}
HARMLESS = {
    "public": 3, "count": 4, "limit": 4, "max": 3, "min": 3, "length": 4, "len": 4, "size": 4, "type": 3, "name": 3, "field": 3, "label": 3, "hint": 3,
    "policy": 3, "url": 2, "uri": 2, "path": 3, "file": 3, "prompt": 4, "expiry": 4, "ttl": 4, "regex": 4, "pattern": 4, "id": 2, "help": 4, "title": 4,
    "description": 4, "message": 4, "error": 4, "example": 2, "dummy": 2, "sample": 2, "placeholder": 4, "column": 3, "header": 2,
}
#: A name counts from here on; name and literal together must reach the second.
LEAST_NAME, LEAST_SCORE = 2, 4.5
#: Names are looked for in so many characters before an operator.
NAME_ROOM = 160
PLACEHOLDER = re.compile(r"(?i)change.?me|your|example|placeholder|dummy|todo|redacted|^<.*>$|^\$?\{.*\}$|^%.*%$|^(.)\1*$|^(none|null|true|false|undefined|nil)$|^[*x.]+$")

OPERATOR = re.compile(r":=|=>|\+=|=(?!=)|:(?![:=])")
NAME_BACK = re.compile(r"""[ \t]*(?:\]?(["'])([\w.\x20$-]{1,64})\1|([\w$.-]+))""")
TYPED = re.compile(r"[ \t]*[A-Za-z_][\w.]*+(?:\[[\w., |]*+\])?[ \t]*+=(?![=>])")
GAP = re.compile(r"[ \t]*+")
JOIN = re.compile(r"""[ \t]*+(?:(?:\+|\.\.|&|\.(?=[ \t]*["'$]))[ \t]*+(?:\\?\r?\n[ \t]*+)?|\\\r?\n[ \t]*+|(?=["']))""")
TERM = re.compile(
    r'''[rbufRBUF@]{0,2}(?:"""(?P<long2>(?s:.*?))"""|\'\'\'(?P<long1>(?s:.*?))\'\'\'|"(?P<double>[^"\\\n]*+(?:\\.[^"\\\n]*+)*+)"|'(?P<single>[^'\\\n]*+(?:\\.[^'\\\n]*+)*+)'|`(?P<back>[^`\n]*+)`)'''
    r"""|(?P<name>\$?\{?[A-Za-z_][\w.]*+\}?)(?P<call>\()"""
    r"""|(?P<bare>[^\s"'`,;(){}\[\]<>=|]++={0,2}|\$\{[\w.]++\})"""
)
LITERALS = ("long2", "long1", "double", "single", "back")
# Pairs that no operator marks: elements, setters, declarations with a type behind the name, flags.
ELEMENT = re.compile(r"<([A-Za-z][\w.:-]{0,63})>([^<>]++)</\1>")
SETTER = re.compile(r"""\([ \t]*(["'])([\w.-]{1,64})\1[ \t]*,[ \t]*(?=["'])""")
DECLARED = re.compile(r"\b(?:var|const|val)[ \t]+([A-Za-z_]\w{0,63})[ \t]+[\w.\[\]*]{1,64}[ \t]*=(?!=)")
FLAG = re.compile(r"(?<![\w-])--([A-Za-z][\w-]{0,63})[ \t]+(?=[^\s=:-])")
USERINFO = re.compile(r"[a-z][a-z0-9+.-]{0,31}://[^\s/:@]{0,128}:([^\s/@]++)@")
NAME_OF_CONSTANT = re.compile(r"[A-Z]+(_[A-Z]+)*")
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

Constant = tuple[tuple[tuple[int, int], ...], bool]


def name_score(name: str) -> int:
    """How sensitive a name is: its best word or pair of words, less what its other words say."""
    words = [w.lower() for w in WORDS.findall(name)]
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    best = max((SENSITIVE.get(w, 0) for w in [*words, *pairs, "".join(words)]), default=0)
    return best - max((HARMLESS.get(w, 0) for w in words), default=0)


def literal_score(value: str, quoted: bool) -> float | None:
    """From nothing to three for how much a literal holds; none if it can be no secret."""
    if len(value) < LEAST_VALUE or PLACEHOLDER.search(value) or NAME_OF_CONSTANT.fullmatch(value):
        return None
    letters, digits = any(c.isalpha() for c in value), any(c.isdigit() for c in value)
    others = any(not c.isalnum() and not c.isspace() for c in value.strip(".,:;!?"))
    if not quoted and (letters + digits + others < 2 or value[-1] in ".,:;!?" or not digits):
        return None
    n = len(value)
    bits = -sum(k * math.log2(k / n) for k in Counter(value).values())
    prose = len(value.split()) > 2 and not digits
    return min(3.0, bits / 24) + 0.5 * (letters + digits + others - 1) - 1.5 * prose


def expression(text: str, at: int) -> tuple[list[Constant], list[str], int]:
    """The constants and names that stand at a place, and where its bare values end.

    Joined literals are one constant, arguments of calls count each.
    """
    constants, names, parts, calls, bare_end = [], [], [], 0, at
    at = GAP.match(text, at).end()
    while True:
        term = TERM.match(text, at)
        if term is None:
            break
        at = term.end()
        kind = next((k for k in LITERALS if term[k] is not None), None)
        if kind:
            parts.append(term.span(kind))
        elif term["call"]:
            calls += 1
            at = GAP.match(text, at).end()
            continue
        else:
            bare_end = at
            names.append(term["bare"].strip("${}"))
            if not parts and not calls:
                constants.append(((term.span("bare"),), False))
        joined = JOIN.match(text, at)
        if joined and (joined.end() > at or text[at : at + 1] in ("'", '"')):
            at = joined.end()
            continue
        if calls and text[at : at + 1] in (",", ")"):
            if parts:
                constants.append((tuple(parts), True))
                parts = []
            if text[at] == ")":
                break
            at = GAP.match(text, at + 1).end()
            continue
        break
    if parts:
        constants.append((tuple(parts), True))
    return constants, names, bare_end


def plain_name(name: str) -> str:
    for before in ("self.", "this."):
        name = name.removeprefix(before)
    return name.strip("$.-")


def pairs(text: str) -> Iterator[tuple[str, list[Constant], list[str]]]:
    """Names with the constants and names that are assigned to them, wherever the text has a syntax for it.

    Nothing is assigned inside a bare value, so each is read once.
    """
    inside = 0
    for found in OPERATOR.finditer(text):
        start, at = found.span()
        if start < inside or start and text[start - 1] in "=!<>:":
            continue
        back = NAME_BACK.match(text[max(0, start - NAME_ROOM) : start][::-1])
        if back is None:
            continue
        if found[0] == ":" and (typed := TYPED.match(text, at)):
            at = typed.end()
        name = plain_name((back[2] or back[3])[::-1])
        constants, names, inside = expression(text, at)
        if name:
            yield name, constants, names
    if "</" in text:
        for found in ELEMENT.finditer(text):
            yield found[1], [((found.span(2),), True)], []
    for pattern, group in ((SETTER, 2), (DECLARED, 1), (FLAG, 1)):
        for found in pattern.finditer(text):
            constants, names, _ = expression(text, found.end())
            yield found[group], constants, names
    if "://" in text:
        for found in USERINFO.finditer(text):
            yield "password", [((found.span(1),), True)], []


def named_secrets(text: str) -> list[tuple[int, int, str, float]]:
    """``start, end, name, score`` of literals that a sensitive name gets, by itself or through other names.

    Names are spread from the most sensitive on, each is visited once, so the work stays in proportion to the text.
    """
    constants, uses = defaultdict(list), defaultdict(list)
    for name, values, names in pairs(text):
        constants[name] += values
        uses[name] += names
    score_of = {name: score for name in constants if (score := name_score(name)) >= LEAST_NAME}
    reached, best = set(), {}
    for source in sorted(score_of, key=lambda name: (-score_of[name], name)):
        todo = [source]
        while todo:
            name = todo.pop()
            if name in reached:
                continue
            reached.add(name)
            for spans, quoted in constants.get(name, ()):
                value = "".join(text[a:b] for a, b in spans)
                if not quoted and value.strip("${}") in constants:
                    continue  # another name, not a value
                own = literal_score(value, quoted)
                if own is not None and own + score_of[source] >= LEAST_SCORE:
                    for span in spans:
                        found = (own + score_of[source], source)
                        if span not in best or found[0] > best[span][0]:
                            best[span] = found
            todo += [plain_name(used) for used in uses.get(name, ())]
    return [(a, b, name, score) for (a, b), (score, name) in best.items()]


def base_spans(text: str) -> Iterator[tuple[str, int, int, str | None]]:
    """Leftmost matches of the patterns that need no name; too short ones are dropped but take their place."""
    if "=" in text or ":" in text:
        for found in ASSIGN.finditer(text):
            if len(found[2]) >= LEAST_VALUE:
                yield "assign", *found.span(), found[1]
    for kind, pattern, least in (("access", ACCESS, LEAST_ACCESS), ("hex", HEX, LEAST_HEX)):
        for found in pattern.finditer(text):
            if found.end() - found.start() >= least:
                yield kind, *found.span(), None


def secrets(text: str) -> list[tuple[str, int, int, str | None, float | None]]:
    """``kind, start, end, name, score`` by start, then kind; literals inside a base span are that span's."""
    base = sorted(base_spans(text), key=lambda one: one[1])
    ends, furthest = [], 0
    for one in base:
        furthest = max(furthest, one[2])
        ends.append(furthest)
    found = [(*one, None) for one in base]
    at = 0
    for start, end, name, score in sorted(named_secrets(text)):
        while at < len(base) and base[at][1] <= start:
            at += 1
        if not at or ends[at - 1] < end:
            found.append((NAMED, start, end, name, score))
    return sorted(found, key=lambda one: (one[1], KINDS.index(one[0]), one[2]))


SPANS = "spans array<struct<kind string, start int, end int, name string, score double>>"


def find(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``spans`` of every whole text: its secrets in code points, ends exclusive.

    A row for each row, repeated ones too. Null and empty texts, and texts without secrets, have no spans. Nothing is
    shuffled; a name with over 160 characters is read by its last ones. A text needs memory for its assignments.
    """

    def make():
        hold_nothing()
        return lambda text: ([dict(zip(("kind", "start", "end", "name", "score"), one, strict=True)) for one in secrets(text or "")],)

    return per_text(docs, text, keep, SPANS, make)


def told(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame, keep: list[str]) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans told."""
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    base = told(F.filter("spans", lambda s: s["kind"] != NAMED))
    return found.select(*keep, *counts, F.sha2(base, 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
