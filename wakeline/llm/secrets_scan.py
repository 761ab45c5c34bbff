"""Secret scans with assignment-aware lexing.

Base patterns find what looks like a secret anywhere in a text. On top of them, each line is lexed as
source code or configuration into name-literal pairs (``name = "x"``, ``name: x``, ``"name": "x"``,
``export NAME=x``, ``name := "x"``, ``<name>x</name>``). Constants are propagated: a name that is bound to another
name or to a concatenation of names and literals passes its sensitivity on to the literals it is
made of. A literal is reported if the most sensitive name it reaches and its own shape score high
enough together.

Positions are code points, ends exclusive. Texts are scanned whole, one row at a time, so nothing is
shuffled and a hot source or a group of copies needs no special care.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from wakeline.llm.columns import appended, cleared, extended
from wakeline.session import ship_package

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "literal", "constant")

# Words in a name that make it sensitive, with their weight.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.8, "secret": 1.0,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "private": 0.6, "auth": 0.6,
    "bearer": 0.8, "signing": 0.5, "encryption": 0.5, "access": 0.4, "key": 0.5, "api": 0.4,
}
PLACEHOLDER = re.compile(r"""(?ix) ^(?: x+ | \*+ | \.+ | <.*> | \$\{?.* | \{\{.*\}\} | %\w+% | (?:change|replace|your|my)[-_ ]?.*
                             | example.* | placeholder.* | dummy.* | none | null | true | false | undefined | todo.* )$""")
THRESHOLD = 1.2
MIN_LITERAL = 8
WINDOW = 256

_NAME = r"[A-Za-z_][\w.\-]{0,80}+"
# The name side must end in a separator, so that prose with colons costs one failed match per separator.
_BIND = re.compile(rf"""(?P<q>["']?)(?P<name>{_NAME})(?P=q)\x20*(?P<sep>:=|=>|[:=](?![:=]))\x20*""")
# A declared type between the colon and the equals sign of a binding. Brackets hold no single colon, so that a
# line of many bindings is read once.
_TYPE_PART = rf"""(?:[&*]*(?:'\w+\x20+)?(?:(?:mut|const|dyn)\x20+)*{_NAME}(?:::{_NAME})*
                  (?:\[(?:[^=\n":]|::)*\]|<(?:[^=\n":]|::)*>)?(?:\[\])*[?!]? | "[^"=\n]*" | '[^'=\n]*')"""
_TYPE = re.compile(rf"""(?x)(?P<type>{_TYPE_PART}(?:\x20*\|\x20*{_TYPE_PART})*)
                        (?:(?P<gap>\x20+)=(?![=>~])\x20*(?=\S) | =\x20*(?=["']))""")
_SUBSCRIPT = re.compile(r"""(?:\[(?:"[^"\n]*"|'[^'\n]*'|[^\]=\n:"']*)\])+\x20*=(?![=>~])\x20*""")
_PLAIN = re.compile(r"[a-z_.\-]+|[A-Z_.\-]+|[A-Z]?[a-z]+(?:[A-Z][a-z]+)*")
# A string literal with any prefix, of triple quotes, double or single quotes, or backticks.
_QUOTED = re.compile(r'''(?:[bBrRfFuU]{1,2}(?=["']))?(?:"""(?P<t>(?:[^"\\]++|\\(?s:.)|"(?!""))*+)"""|"(?P<d>(?:[^"\\\n]++|\\.)*+)"
                      |'(?P<s>(?:[^'\\\n]++|\\.)*+)'|`(?P<b>[^`\n]*+)`)''', re.X)
# A dotted name right before an opening bracket is what is called, not a value.
_CALLEE = re.compile(rf"[$@&*]*{_NAME}\(")
_BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>]+")
_PLUS = re.compile(r"\x20*[+.]\x20*")
_IDENT = re.compile(rf"{_NAME}\Z")
_TAG = re.compile(rf"<(?P<name>{_NAME})>(?P<value>[^<>\s]++)</(?P=name)>")
# First and last line of a key, with the line breaks that a literal writes as escapes.
_ARMOR = re.compile(r"-----(?:BEGIN|END) [A-Z0-9 ]+-----")
_SPACE = re.compile(r"\s")
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z0-9])(?=[A-Z])")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, failing matches dropped."""
    found = []
    if ":" in text or "=" in text:
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def sensitivity(name: str) -> float:
    """Sum of the weights of a name's words (``dbPassword``, ``API_KEY``), at most 1."""
    words = [w.lower() for w in _SPLIT.split(name) if w]
    joined = "".join(words)
    return min(1.0, max(sum(NAME_WEIGHTS.get(w, 0.0) for w in words), NAME_WEIGHTS.get(joined, 0.0)))


def _entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(x / n * math.log2(x / n) for x in Counter(value).values())


def strength(value: str) -> float:
    """0 to 1: how much a literal looks like a generated or chosen secret rather than a word.

    Its entropy is the whole literal's or that of its strongest window, so padding does not hide a secret."""
    if len(value) < MIN_LITERAL or PLACEHOLDER.match(value):
        return 0.0
    value = _ARMOR.sub("", value)
    if not value or _SPACE.search(value):
        return 0.0
    classes = sum(map(bool, (re.search("[a-z]", value), re.search("[A-Z]", value), re.search("[0-9]", value),
                             re.search("[^A-Za-z0-9]", value))))
    if classes < 2:
        return 0.2
    entropy = max(map(_entropy, [value, *(value[i:i + WINDOW] for i in range(0, len(value), WINDOW))]))
    return min(1.0, entropy / 4.5) * (0.25 + 0.25 * classes)


def _is_name(word: str) -> bool:
    """Whether a word right before an equals sign is a name rather than a padded literal."""
    return len(word) < MIN_LITERAL - 1 or bool(_PLAIN.fullmatch(word)) or sensitivity(word) > 0


def pairs(text: str) -> list[tuple[str, list[tuple[str, int, int, bool]], list[str]]]:
    """Bindings in order: (name, literals as (value, start, end, never a name), names referred to).

    A bare value that is a name with a binding of its own (``a = b = "x"``, ``a: b: x``) is referred to, and its binding is
    read next. A declared type (``a: T = "x"``) is read over; it is bound too if it could be a name. In a bare value
    that holds bindings (``a: b=x``) the first and the first sensitive one are read; later literals lie inside theirs.
    """
    out = []
    at = first = inside = 0
    for m in _BIND.finditer(text):
        start, name = m.start(), m["name"]
        nested = first <= start < inside
        if start < at and not (nested and (start == first or sensitivity(name))):
            continue
        pos, literals, refs, also, upto = m.end(), [], [], None, None
        if m["sep"] == ":" and (t := _TYPE.match(text, pos)):
            kind = t["type"].strip("\"'")
            if t["gap"] or not _IDENT.match(kind) or _is_name(kind):
                pos = t.end()
                if _IDENT.match(kind) and (not t["gap"] or sensitivity(kind)):
                    also = kind
        while True:
            if q := _QUOTED.match(text, pos):
                kind = q.lastgroup
                literals.append((q[kind], q.start(kind), q.end(kind), False))
                pos = q.end()
            elif c := _CALLEE.match(text, pos):
                pos = c.end()
                break
            elif b := _BARE.match(text, pos):
                begin = pos + (b[0][0] in "$@")
                n = None if nested else _BIND.match(text, begin)
                tight = n and n.start("sep") < b.end()
                word = b[0].rstrip(".:")
                pos = b.end()
                if n and n.end() >= b.end() and (n["sep"] != "=" or not tight or _is_name(n["name"])):
                    refs.append(n["name"])
                    if len(word) >= MIN_LITERAL and "=" not in word:
                        literals.append((word, b.start(), b.start() + len(word), n["sep"] == ":"))
                    upto = begin
                    break
                if n and n.end() < b.end():
                    first, inside = begin, b.end()
                if _IDENT.match(word):
                    refs.append(word)
                if len(word) >= MIN_LITERAL:
                    literals.append((word, b.start(), b.start() + len(word), False))
                if s := _SUBSCRIPT.match(text, pos):
                    pos = s.end()
                    continue
            else:
                break
            plus = _PLUS.match(text, pos)
            if not plus:
                break
            pos = plus.end()
        if literals or refs:
            out.append((name, literals, refs))
            if also:
                out.append((also, literals, refs))
            at = max(at, pos if upto is None else upto)
            if nested and sensitivity(name):
                inside = 0
    for m in _TAG.finditer(text):
        out.append((m["name"], [(m["value"], m.start("value"), m.end("value"), False)], []))
    return out


def lexed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of literals that reach a sensitive name.

    ``literal``: bound to the name itself; ``constant``: through other names. Sensitivity flows from
    a name to the names it was built from until nothing changes, cycles included; a rebound name
    shares one score for all its bindings.
    """
    if not ("=" in text or ":" in text or "</" in text):
        return []
    bound = pairs(text)
    own = {name: sensitivity(name) for name, _, _ in bound}
    if not any(own.values()):
        return []
    reach = dict(own)
    sources: dict[str, set[str]] = {}
    for name, _, refs in bound:
        sources.setdefault(name, set()).update(r for r in refs if r in own)
    todo = [n for n, s in own.items() if s]
    while todo:
        name = todo.pop()
        for ref in sources[name]:
            if reach[ref] < reach[name]:
                reach[ref] = reach[name]
                todo.append(ref)
    found = set()
    for name, literals, _ in bound:
        if reach[name] <= 0:
            continue
        for value, start, end, sure in literals:
            if value in own and not sure:
                continue
            strong = strength(value)
            if reach[name] + strong >= THRESHOLD and strong > 0.2:
                found.add((start, 3 if own[name] >= reach[name] else 4, end))
    return sorted(found)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_text(text: str | None) -> tuple[int, int, int, str, str]:
    """n_assign, n_access, n_hex, base_sha256, spans of one text; null is scanned as empty."""
    text = text or ""
    base = base_spans(text)
    every = sorted(set(base) | set(lexed_spans(text)))
    kinds = [k for _, k, _ in base]
    return kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)


def redact_text(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every found secret replaced; an assignment keeps its name."""
    if not text:
        return text
    cuts = []
    for start, kind, end in set(base_spans(text)) | set(lexed_spans(text)):
        if kind == 0:
            found = ASSIGN.match(text, start)
            start = found.start(2)
            # A call is code: its name is left, as nothing of it is a value.
            if text[start - 1] not in "\"'" and _CALLEE.match(text, start) and text[end:end + 1] == "(":
                continue
        cuts.append((start, end))
    if not cuts:
        return text
    out, at = [], 0
    for start, end in sorted(cuts):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scanned(docs: DataFrame, text: str = "text", redact_to: str | None = None, prefix: str = "") -> DataFrame:
    """``docs`` plus n_assign, n_access, n_hex, base_sha256 and spans (each with ``prefix``); with
    ``redact_to``, also the redacted text under that name.

    Null and empty texts have no spans, and a null text stays null when redacted. Repeated rows are
    scanned alike. Every other column passes through; one with the name of an output is replaced by it
    (``prefix`` keeps it).
    """
    ship_package(docs.sparkSession)
    kinds = [("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
             ("base_sha256", pa.string()), ("spans", pa.string())]
    docs = cleared(docs, [prefix + n for n, _ in kinds] + [redact_to])
    schema = extended(docs, [(prefix + n, "long" if t == pa.int64() else "string") for n, t in kinds]
                      + ([(redact_to, "string")] if redact_to else []))

    def run(batches):
        for batch in batches:
            texts = [x.as_py() for x in batch.column(batch.schema.get_field_index(text))]
            rows = [scan_text(x) for x in texts]
            cols = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)]
            names = [prefix + n for n, _ in kinds]
            if redact_to:
                cols.append(pa.array([redact_text(x) for x in texts], pa.string()))
                names.append(redact_to)
            yield appended(batch, names, cols)

    return docs.mapInArrow(run, schema)
