"""Secret scans by assignment-aware lexing.

Every text gets the spans of the base kinds (`assign`, `access`, `hex`), which
are plain patterns. Texts that name something sensitive are read as source or
configuration besides:

1. A lexer cuts the text into strings, names, numbers and operators.
2. Around every assignment (`=`, `:=`, `:`, `=>`, a keyword argument, an
   element such as <password>..</password>, an option such as --token ..) the
   name on its left and the literal on its right make a pair: quoted strings,
   joined ones, string arguments of a call, or a bare value. Keys of maps,
   subscripts and typed declarations name their value too. User and password
   of an address (scheme://user:password@host) are a pair as well.
3. A name on the right makes its literals those of the name on the left, over
   any number of steps: constants are propagated from the sensitive names
   back along the assignments of the text.
4. A literal is scored by the most sensitive name that it reaches (its words
   and what they say against a secret, such as a path or a length) times its
   own strength (bits of its letters' entropy, less for plain words, nothing
   for placeholders and references). From LEAST_SCORE on it is a span of kind
   `literal`, unless a span of a base kind lies over it.

Texts are read one by one in tasks, each in time linear in its length; nothing
is shuffled.

Defined cases: a null text is empty and has no spans. Positions count code
points, ends are exclusive. Of equal spans one is kept. A text may be one line
of any length. Rows that repeat have the same result; a null id changes
nothing; extra columns play no part. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm.shared import prepare, small

KINDS = ("assign", "access", "hex", "literal")
LEAST_SCORE = 0.5

# -- base kinds ------------------------------------------------------------

_STEMS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I)
# A shorter match that fails holds no longer one, so these need no second look.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")


def base_spans(text: str, lower: str) -> list[tuple[str, int, int]]:
    out = []
    if any(s in lower for s in _STEMS):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# -- names and literals ----------------------------------------------------

#: How sensitive a word of a name is.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pwd": 1.0, "pass": 0.8, "secret": 1.0, "secrets": 0.9, "token": 0.9, "apikey": 1.0, "authkey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "authorization": 0.8, "auth": 0.6, "privatekey": 1.0, "secretkey": 1.0, "accesskey": 1.0, "cookie": 0.5, "signature": 0.5, "salt": 0.6,
}
#: How sensitive two neighbouring words of a name are.
SENSITIVE_PAIRS = {
    ("api", "key"): 1.0, ("access", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0, ("auth", "key"): 1.0, ("encryption", "key"): 1.0, ("signing", "key"): 1.0, ("master", "key"): 1.0,
    ("account", "key"): 0.9, ("license", "key"): 0.6, ("session", "key"): 0.8, ("session", "id"): 0.5, ("webhook", "url"): 0.5,
}
#: Words that say the value is about a secret and not one.
ABOUT = frozenset("file path dir url uri name length len size min max count type format hint prompt label field policy public id expires expiry ttl regex pattern required enabled reset".split())
#: Any text with a pair to be scored has one of these, or an address with a password.
NAME_STEMS = ("pass", "pwd", "secret", "token", "key", "cred", "bearer", "auth", "cookie", "signature", "salt", "session", "webhook")

_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def sensitivity(name: str) -> float:
    """0 to 1: how much a name says that its value is a secret."""
    words = [w.lower() for w in _WORD.findall(name)]
    best = max([SENSITIVE.get(w, 0.0) for w in words] + [SENSITIVE_PAIRS.get(p, 0.0) for p in zip(words, words[1:])], default=0.0)
    return best * (0.3 if words and words[-1] in ABOUT else 1.0)


#: Values that stand for a secret to be filled in, or for none.
PLACEHOLDER = re.compile(
    r"\s*$|.*(\$\{|\{\{|<[A-Za-z]|%\(|%s|\$\(|change.?me|example|placeholder|your[-_ ]|dummy|redacted|xxxx|\*\*\*|\.\.\.|todo|insert[-_ ])|(true|false|null|none|nil|undefined|yes|no|string|str|test|secret|password|token|default)$",
    re.I | re.S,
)


def strength(literal: str, quoted: bool) -> float:
    """0 to 1: how much a value looks like a secret."""
    n = len(literal)
    if n < 6 or PLACEHOLDER.match(literal):
        return 0.0
    counts = Counter(literal)
    bits = n * math.log2(n) - sum(c * math.log2(c) for c in counts.values())
    out = min(1.0, bits / 36)
    if re.fullmatch(r"[A-Z][A-Z0-9_]*", literal) and "_" in literal or re.match(r"(https?://|[./~]|[A-Za-z]:\\)", literal):
        out *= 0.3  # names of settings, addresses and paths
    if any(c.isspace() for c in literal):
        out *= 0.5
    if literal.isalpha() and (literal.islower() or literal.istitle()):
        out *= 0.8 if quoted else 0.4
    return out


# -- lexer -----------------------------------------------------------------

_TOKEN = re.compile(
    r"""(?P<space>[^\S\n]+)|(?P<line>\n)
    |(?P<string>(?:\b[bBrRuUfF]{1,2})?(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\\n]|\\.)*`))
    |(?P<name>[^\W\d][\w$]*(?:['’][^\W\d_]+\b(?!['"]))?(?:[.-][^\W\d][\w$]*)*)
    |(?P<number>\d[\w.]*)
    |(?P<equal>[=!<>]=+|->)
    |(?P<assign>:=|=>|=|:(?!:))
    |(?P<other>\\.|.)""",
    re.X | re.S,
)
#: A value without quotes; it ends where another assignment begins.
_BARE = re.compile(r"[^\s\"'`,;<>(){}\[\]|&=:]+={0,2}")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*)>([^<>\n]+)</")
_LOGIN = re.compile(r"://[^\s/:@\"'<>]+:([^\s/@\"'<>]+)@")
#: Words between a name and `=` that are types, and modifiers that are no targets.
TYPES = frozenset("string str String char byte bytes Text text varchar String[] const auto var let final static".split())


def _inside(text: str, start: int, end: int) -> tuple[int, int]:
    """Bounds of what a string token has between its quotes."""
    while text[start] not in "\"'`":
        start += 1
    return start + 1, end - 1


def _target(text: str, tokens: list, i: int) -> str | None:
    """The name that the assignment at token i gives a value to."""
    k = i - 1
    if k >= 0 and tokens[k][0] == "other" and text[tokens[k][1]] == "]":
        k -= 1  # a subscript: the string in it names the value
        if k < 0 or tokens[k][0] != "string":
            return None
    if k < 0 or tokens[k][0] not in ("name", "string"):
        return None
    kind, start, end = tokens[k]
    if kind == "string":
        return text[slice(*_inside(text, start, end))]
    if k >= 2 and tokens[k - 1][0] == "assign" and text[tokens[k - 1][1]] == ":" and tokens[k - 2][0] == "name" and text[tokens[i][1]] == "=":
        return text[tokens[k - 2][1]:tokens[k - 2][2]]  # name: type = value
    if text[start:end] in TYPES and k >= 1 and tokens[k - 1][0] == "name":
        return text[tokens[k - 1][1]:tokens[k - 1][2]]  # name type = value
    return text[start:end]


def pairs(text: str) -> Iterator[tuple[str, int, int, bool] | tuple[str, str]]:
    """(name, start, end, quoted) of literals with the name that they are given to, and (name, other name) of names given to names."""
    tokens = [(m.lastgroup, m.start(), m.end()) for m in _TOKEN.finditer(text) if m.lastgroup != "space"]
    n = len(tokens)
    for i, (kind, start, end) in enumerate(tokens):
        if kind == "assign" and i + 1 < n:
            name = _target(text, tokens, i)
            if name:
                yield from _values(text, tokens, i + 1, name)
        elif kind == "other" and text[start:end] == "-" and 0 < i < n - 2 and tokens[i + 1][0] == "name" and text[tokens[i - 1][1]:start] == "-" and tokens[i + 2][0] in ("name", "string", "number"):
            yield from _values(text, tokens, i + 2, text[tokens[i + 1][1]:tokens[i + 1][2]])
    for m in _ELEMENT.finditer(text):
        yield m[1], *m.span(2), True
    for m in _LOGIN.finditer(text):
        yield "password", *m.span(1), True


def _values(text: str, tokens: list, i: int, name: str) -> Iterator[tuple]:
    """What stands at token i, the right of an assignment to this name."""
    kind, start, end = tokens[i]
    if kind == "string":
        yield name, *_inside(text, start, end), True
        # Strings that are joined to it count on their own and as parts.
        while i + 1 < len(tokens):
            if tokens[i + 1][0] == "string":
                i += 1
            elif i + 2 < len(tokens) and text[tokens[i + 1][1]:tokens[i + 1][2]] in ("+", ".", "..") and tokens[i + 2][0] == "string":
                i += 2
            else:
                break
            yield name, *_inside(text, *tokens[i][1:]), True
    elif kind in ("name", "number", "other") and (m := _BARE.match(text, start)):
        after = i + 1
        if kind == "name" and after < len(tokens) and text[tokens[after][1]] == "(" and tokens[after][1] == end:
            after += 1  # the call's own arguments, up to the next bracket or assignment
            while after < len(tokens) and tokens[after][0] not in ("line", "assign") and text[tokens[after][1]] not in "()":
                if tokens[after][0] == "string":
                    yield name, *_inside(text, *tokens[after][1:]), True
                after += 1
        elif kind == "name" and m.end() == end:
            yield name, text[start:end]
            yield name, *m.span(), False
        else:
            yield name, *m.span(), False


def reached(found: list[tuple]) -> dict[str, tuple[float, str]]:
    """For each name the highest sensitivity of the names that its value is given to, and which one it is; names without any are left out."""
    out: dict[str, tuple[float, str]] = {}
    sources: dict[str, list[str]] = {}
    for p in found:
        if len(p) == 2:
            sources.setdefault(p[0], []).append(p[1])
        if p[0] not in out:
            out[p[0]] = (sensitivity(p[0]), p[0])
    # From the most sensitive names back; each name is settled once.
    settled: set[str] = set()
    for start in sorted(out, key=lambda k: (-out[k][0], k)):
        todo, best = [start], out[start]
        while todo:
            name = todo.pop()
            if name in settled:
                continue
            settled.add(name)
            out[name] = max(out.get(name, best), best)
            todo += sources.get(name, ())
    return {k: v for k, v in out.items() if v[0] > 0}


def literal_spans(text: str, lower: str) -> list[tuple[int, int, str, float]]:
    """start, end, name and score of the literals that are taken for secrets."""
    if not (any(s in lower for s in NAME_STEMS) or "://" in text) or not any(c in text for c in "=:<") and "--" not in text:
        return []
    found = list(pairs(text))
    names, targets = reached(found), {p[0] for p in found}
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for p in found:
        # A bare word that the text gives a value to is a name and no literal.
        if len(p) == 4 and (hit := names.get(p[0])) and (p[3] or text[p[1]:p[2]] not in targets):
            score = hit[0] * strength(text[p[1]:p[2]], p[3])
            if score >= LEAST_SCORE:
                best[p[1], p[2]] = max(best.get((p[1], p[2]), (0.0, "")), (score, hit[1]))
    return [(s, e, name, score) for (s, e), (score, name) in sorted(best.items())]


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, str | None, float | None]]]:
    """Base spans, and all spans with the name and score of the added ones, both by start, then kind."""
    lower = text.lower()
    base = base_spans(text, lower)
    every = [(*s, None, None) for s in base]
    ends = sorted((s, e) for _, s, e in base)
    k, furthest = 0, 0
    for s, e, name, score in literal_spans(text, lower):
        while k < len(ends) and ends[k][0] < e:
            furthest, k = max(furthest, ends[k][1]), k + 1
        if furthest <= s:
            every.append(("literal", s, e, name, score))
    return base, sorted(every, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def digest(spans) -> str:
    """kind:start:end of spans, joined by commas."""
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, base_sha256, spans (as text) and found: kind, start, end, and for literals the sensitive name and the score."""
    prepare(docs.sparkSession)
    parts = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]

    def run(batches):
        for batch in small(batches):
            results = [scan(t or "") for t in batch.column(1).to_pylist()]
            counts = [[sum(s[0] == kind for s in base) for base, _ in results] for kind in KINDS[:3]]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array([hashlib.sha256(digest(base).encode()).hexdigest() for base, _ in results], pa.string()), pa.array([digest(every) for _, every in results], pa.string()),
                pa.array([[dict(zip(("kind", "start", "end", "name", "score"), s)) for s in every] for _, every in results], pa.list_(pa.struct(parts))),
            ], ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, found array<struct<kind:string,start:long,end:long,name:string,score:double>>")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document."""
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found").withColumnRenamed("id", "doc_id")
