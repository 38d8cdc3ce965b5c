"""Personal data by weak supervision, in built-in functions only.

Four base kinds have exact rules and always count: email, ip, card, phone.
Beyond them, candidate spans of further kinds (secret, number, name) are voted
on by labelers that know nothing of each other: a regular expression, a
gazetteer, the context before the span, and its shape. The votes of all
candidates are counted by pattern (at most 3^4 patterns a kind); expectation
maximisation on these counts estimates how reliable each labeler is, without
any label. Its posteriors then train the final span classifier, a naive Bayes
model over properties of the span and its surroundings, whose sums are taken
over all candidates. Only pattern counts and feature sums, both bounded by
their vocabularies, come to the driver. Candidates that the classifier accepts
and that overlap no base span are added.

Matches are leftmost and non-overlapping for each kind. The regular expressions
are possessive, so that none of them recurses or backtracks over long texts.
Positions are code points, the end exclusive.

Defined cases: a null text has no spans (redaction leaves it null). Texts may
be of any length. Rows are judged each on its own: null or repeated ids and
extra columns make no difference. With no candidates there are no added spans.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm.shared import stored

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "number", "name")
LABELERS = ("regex", "gazetteer", "context", "shape")
CONTEXT = 24
EM_ROUNDS = 60
SMOOTHING = 1.0

#: Common given names and titles: what a name can begin with.
GAZETTEER = (
    "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen "
    "Daniel Nancy Matthew Lisa Anthony Betty Mark Margaret Paul Sandra Hans Anna Peter Ursula Klaus Monika Jean Marie Pierre Jeanne Michel Isabelle "
    "Antonio Maria Jose Carmen Manuel Josefa Francisco Isabel"
).split()
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora")

_LOCAL = "[A-Za-z0-9._%+-]"
_KEY = "[A-Za-z0-9_+/=-]"
PATTERNS = {
    # A local part starts where its run starts or where the last match ended: other starts in a run fail as that one does.
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": rf"(?<!{_KEY}){_KEY}{{16,}}+",
    "number": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){6,}+",
    "name": rf"(?<![\p{{L}}])(?:(?:{'|'.join(TITLES)})\.?|(?:{'|'.join(GAZETTEER)}))\x20\p{{Lu}}\p{{Ll}}++",
}
#: What a text must have for a pattern to match at all, cheaper to look for.
_NEEDS = {"email": "instr({t}, '@') > 0", "phone": "instr({t}, '+') > 0"}

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_LUHN = (
    "aggregate(sequence(1, length(d)), 0, (s, i) -> s + IF(i % 2 = 1, cast(substring(d, length(d) + 1 - i, 1) AS INT), "
    "cast(substring(d, length(d) + 1 - i, 1) AS INT) * 2 - IF(substring(d, length(d) + 1 - i, 1) >= '5', 9, 0))) % 10 = 0"
)
_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
CHECKS = {
    "email": "true",
    "ip": rf"x.m RLIKE '^{_PART}(?:\\.{_PART}){{3}}$'",
    "card": f"length({_DIGITS}) BETWEEN 13 AND 19 AND element_at(transform(array({_DIGITS}), d -> {_LUHN}), 1)",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
}


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: Matches, or spans, that are put into one array; blocks of them are then joined.
BLOCK = 256


def matches(text: str, kind: str) -> Column:
    """Matches of a kind's pattern in a text column as an array of (s, e, m).

    Matches are marked in the text with two control characters (which stand in
    no pattern's classes; those of the text itself are replaced first), the
    text is split at them, and the lengths of the parts give the positions.
    """
    marked = f"regexp_replace(translate({text}, '\\u0001\\u0002', '\\u0003\\u0003'), {_quoted(PATTERNS[kind])}, '\\u0001$0\\u0002')"
    if kind in _NEEDS:
        marked = f"IF({_NEEDS[kind].format(t=text)}, {marked}, '')"
    none = "cast(array() AS ARRAY<STRUCT<s: INT, e: INT, m: STRING>>)"
    # An array grows by copying, so parts are taken in blocks: within one from where it starts, which the lengths of the blocks before it say.
    blocks = f"transform(sequence(0, (size(p) - 2) div {BLOCK}), k -> slice(p, 2 + k * {BLOCK}, {BLOCK}))"
    starts = "aggregate(b, array(length(p[0])), (o, y) -> concat(o, array(element_at(o, -1) + aggregate(y, 0, (n, x) -> n + length(x) - 1))))"
    within = (
        f"aggregate(y, named_struct('at', at, 'out', {none}), (a, x) -> named_struct('at', a.at + length(x) - 1, 'out', "
        "concat(a.out, array(named_struct('s', a.at, 'e', a.at + length(substring_index(x, '\\u0002', 1)), 'm', substring_index(x, '\\u0002', 1))))), a -> a.out)"
    )
    found = f"element_at(transform(array({blocks}), b -> flatten(zip_with(b, slice({starts}, 1, size(b)), (y, at) -> {within}))), 1)"
    return F.expr(f"element_at(transform(array(split({marked}, '\\u0001', -1)), p -> IF(size(p) > 1, {found}, {none})), 1)")


def _any(words: str) -> str:
    return f"RLIKE '(?:{words})[^\\\\p{{L}}]*$'"


#: For each kind the votes (1 yes, -1 no, 0 no opinion) on a candidate x: its text m, the CONTEXT before it in lower case, the character after.
VOTES = {
    "secret": {
        "regex": "CASE WHEN x.m RLIKE '^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$' OR x.m RLIKE '[0-9]' AND x.m RLIKE '[a-z]' AND x.m RLIKE '[A-Z]' AND length(x.m) >= 20 THEN 1 WHEN x.m RLIKE '^[A-Za-z=/_+-]+$' THEN -1 ELSE 0 END",
        "gazetteer": "CASE WHEN x.m RLIKE '^(?:sk|pk|rk|ghp|gho|xox[abp]|AKIA|AIza|eyJ)[A-Za-z0-9_-]' THEN 1 ELSE 0 END",
        "context": f"CASE WHEN x.before {_any('token|secret|password|passwd|pwd|api.?key|key|bearer|auth')} THEN 1 WHEN x.before RLIKE '[\\\\p{{L}}.,] $' THEN -1 ELSE 0 END",
        "shape": "CASE WHEN length(regexp_replace(x.m, '[^0-9]', '')) * 5 >= length(x.m) AND length(regexp_replace(x.m, '[^A-Za-z]', '')) > 0 THEN 1 ELSE -1 END",
    },
    "number": {
        "regex": "CASE WHEN x.m RLIKE '^[0-9]{13,19}$' OR x.m RLIKE '^[0-9]{4}(?:[ -][0-9]{4}){2,}' OR x.m RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$' THEN 1 WHEN x.m RLIKE '^(?:19|20)[0-9]{2}[ ./-]' THEN -1 ELSE 0 END",
        "gazetteer": "CASE WHEN x.m RLIKE '^(?:4|5[1-5]|2[2-7]|3[47]|6011|35)' AND length(regexp_replace(x.m, '[^0-9]', '')) BETWEEN 13 AND 19 THEN 1 ELSE 0 END",
        "context": f"CASE WHEN x.before {_any('card|account|acct|iban|ssn|passport|phone|tel|fax|mobile|konto|karte|compte|cuenta|nr|no')} THEN 1 WHEN x.before RLIKE '[$€£#.,%]$' THEN -1 ELSE 0 END",
        "shape": "CASE WHEN length(regexp_replace(x.m, '[^0-9]', '')) BETWEEN 9 AND 19 AND NOT x.m RLIKE '[./]' THEN 1 ELSE -1 END",
    },
    "name": {
        "regex": "CASE WHEN x.m RLIKE '^\\\\p{Lu}\\\\p{Ll}+\\\\.? \\\\p{Lu}\\\\p{Ll}{2,}$' THEN 1 ELSE 0 END",
        "gazetteer": f"CASE WHEN x.m RLIKE '^(?:{'|'.join(GAZETTEER)}) ' THEN 1 ELSE 0 END",
        "context": f"CASE WHEN x.before {_any('name|contact|by|from|dear|patient|mr|mrs|dr')} THEN 1 ELSE 0 END",
        "shape": "CASE WHEN x.after = '' OR x.after RLIKE '^[^\\\\p{L}]$' THEN 1 ELSE -1 END",
    },
}


def _class(char: str) -> str:
    return f"CASE WHEN {char} = '' THEN 'none' WHEN {char} RLIKE '^[\"\\'=:]$' THEN 'mark' WHEN {char} RLIKE '^\\\\s$' THEN 'space' WHEN {char} RLIKE '^\\\\p{{L}}$' THEN 'letter' WHEN {char} RLIKE '^[0-9]$' THEN 'digit' ELSE 'other' END"


#: Properties that the final classifier looks at; each has few values.
FEATURES = {
    "length": "cast(least(floor(log2(length(x.m))), 10) AS STRING)",
    "digits": "cast(floor(4 * length(regexp_replace(x.m, '[^0-9]', '')) / length(x.m)) AS STRING)",
    "distinct": "cast(least(floor(size(array_distinct(split(x.m, ''))) / 4), 8) AS STRING)",
    "before": _class("substring(x.before, -1, 1)"),
    "after": _class("x.after"),
    "case": "CASE WHEN x.m RLIKE '[A-Z]' AND x.m RLIKE '[a-z]' THEN 'both' WHEN x.m RLIKE '[A-Z]' THEN 'upper' WHEN x.m RLIKE '[a-z]' THEN 'lower' ELSE 'no' END",
    "word": "CASE WHEN regexp_extract(x.before, '(\\\\p{L}+)[^\\\\p{L}]*$', 1) IN ('token', 'secret', 'password', 'key', 'card', 'account', 'phone', 'tel', 'name', 'contact', 'by') THEN 'cue' ELSE 'other' END",
}


def span_columns(text: str) -> list[Column]:
    """The base spans of a text column, kind by kind, and its candidates with their votes and features."""
    out = [F.expr(f"filter({kind}_, x -> {CHECKS[kind]})").alias(kind) for kind in BASE_KINDS]
    seen = "concat(" + ", ".join(f"filter({kind}_, x -> {CHECKS[kind]})" for kind in BASE_KINDS) + ")"
    for kind in ADDED_KINDS:
        free = f"filter({kind}_, x -> NOT exists({seen}, b -> b.s < x.e AND x.s < b.e))"
        around = f"transform({free}, x -> named_struct('s', x.s, 'e', x.e, 'm', x.m, 'before', lower(substring({text}, greatest(x.s - {CONTEXT}, 0) + 1, least(x.s, {CONTEXT}))), 'after', substring({text}, x.e + 1, 1)))"
        votes = "concat_ws('', " + ", ".join(f"cast(({VOTES[kind][name]}) + 1 AS STRING)" for name in LABELERS) + ")"
        features = "array(" + ", ".join(f"concat('{name}:', {value})" for name, value in FEATURES.items()) + ")"
        out.append(F.expr(f"transform({around}, x -> named_struct('s', x.s, 'e', x.e, 'votes', {votes}, 'features', {features}))").alias(kind))
    return out


def with_spans(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """Columns to keep, and a column of each kind's spans."""
    found = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_")).select(*keep, "text_", *[matches("text_", kind).alias(f"{kind}_") for kind in (*BASE_KINDS, *ADDED_KINDS)])
    return found.select(*keep, *span_columns("text_"))


def reliabilities(counts: dict[str, int]) -> tuple[float, list[list[float]], list[list[float]], dict[str, float]]:
    """Expectation maximisation over vote patterns ('0' no, '1' no opinion, '2' yes for each labeler, with counts).

    Returns the share of true spans, each labeler's vote probabilities for
    true and for false spans, and the posterior of every pattern.
    """
    total = sum(counts.values())
    share = 0.5
    true, false = [[0.1, 0.3, 0.6] for _ in LABELERS], [[0.6, 0.3, 0.1] for _ in LABELERS]
    post = {}
    for _ in range(EM_ROUNDS):
        for pattern in counts:
            a = math.log(share) + sum(math.log(true[k][int(v)]) for k, v in enumerate(pattern))
            b = math.log(1 - share) + sum(math.log(false[k][int(v)]) for k, v in enumerate(pattern))
            post[pattern] = 1 / (1 + math.exp(min(max(b - a, -700), 700)))
        positive = sum(n * post[p] for p, n in counts.items())
        share = min(max((positive + SMOOTHING) / (total + 2 * SMOOTHING), 1e-6), 1 - 1e-6)
        for k, v in product(range(len(LABELERS)), range(3)):
            yes = sum(n * post[p] for p, n in counts.items() if p[k] == str(v))
            no = sum(n * (1 - post[p]) for p, n in counts.items() if p[k] == str(v))
            true[k][v] = (yes + SMOOTHING) / (positive + 3 * SMOOTHING)
            false[k][v] = (no + SMOOTHING) / (total - positive + 3 * SMOOTHING)
    return share, true, false, post


def train(spans: DataFrame) -> dict[str, tuple[float, dict[str, float]]]:
    """For each added kind the classifier: a bias and the log odds of each feature value. spans has the candidates of all rows."""
    candidates = None
    for kind in ADDED_KINDS:
        one = spans.select(F.lit(kind).alias("kind"), F.explode(kind).alias("x")).select("kind", "x.votes", "x.features")
        candidates = one if candidates is None else candidates.union(one)
    patterns: dict[str, dict[str, int]] = {kind: {} for kind in ADDED_KINDS}
    for row in candidates.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect():
        patterns[row.kind][row.votes] = row.n
    models, posts = {}, {}
    for kind, counts in patterns.items():
        if counts:
            share, _, _, post = reliabilities(counts)
            models[kind] = (math.log(share / (1 - share)), {}, sum(n * post[p] for p, n in counts.items()), sum(counts.values()))
            posts.update({f"{kind}{p}": q for p, q in post.items()})
    if not posts:
        return {}
    post = F.create_map(*[F.lit(x) for pair in posts.items() for x in pair])
    sums = (
        candidates.withColumn("post", post[F.concat("kind", "votes")]).select("kind", "post", F.explode("features").alias("feature"))
        .groupBy("kind", "feature").agg(F.sum("post").alias("yes"), F.sum(1 - F.col("post")).alias("no")).collect()
    )
    for row in sums:
        _, odds, positive, total = models[row.kind]
        odds[row.feature] = math.log((row.yes + SMOOTHING) / (positive + 10 * SMOOTHING)) - math.log((row.no + SMOOTHING) / (total - positive + 10 * SMOOTHING))
    return {kind: (bias, odds) for kind, (bias, odds, _, _) in models.items()}


def accepted(kind: str, models: dict[str, tuple[float, dict[str, float]]]) -> Column:
    """The candidates of a kind that the classifier takes for personal data."""
    if kind not in models:
        return F.filter(F.col(kind), lambda x: F.lit(False))
    bias, odds = models[kind]
    table = F.create_map(*[F.lit(x) for pair in sorted(odds.items()) for x in pair]) if odds else None
    score = lambda x: F.aggregate(x["features"], F.lit(bias), lambda a, f: a + F.coalesce(table[f], F.lit(0.0)))
    return F.filter(F.col(kind), lambda x: score(x) > 0)


def _spans(kind: str, column: Column) -> Column:
    return F.transform(column, lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def judged(spans: DataFrame, models: dict) -> DataFrame:
    """spans with `base` and `every`: arrays of (kind, s, e), by kind and start."""
    base = F.concat(*[_spans(kind, F.col(kind)) for kind in BASE_KINDS])
    added = F.concat(*[_spans(kind, accepted(kind, models)) for kind in ADDED_KINDS])
    return spans.withColumn("base", base).withColumn("every", F.concat(base, added))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, numbers of the base kinds, base and every (arrays of kind, s, e)."""
    spans = stored(with_spans(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body")), "body", "id"), "pii-spans")
    found = judged(spans, train(spans))
    return found.select("id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS], "base", "every")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every span in the text replaced by its kind in brackets; of overlapping spans the first one names the place."""
    texts = docs.select(F.col(text_col).alias("body"))
    spans = stored(with_spans(texts, "body").select(*ADDED_KINDS), "pii-candidates")
    models = train(spans)
    names = [f"c{i}" for i in range(len(docs.columns))]
    place = names[docs.columns.index(text_col)]
    rows = docs.toDF(*names)
    found = judged(with_spans(rows, place, *names), models)
    ordered = F.array_sort(F.transform("every", lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["kind"].alias("kind"))))
    found = found.withColumn("ordered_", ordered)
    text = f"cast({place} AS STRING)"
    # Spans in blocks, each with the furthest end before it and its own stretch of the text, in which positions are short.
    blocks = f"transform(sequence(0, (size(ordered_) - 1) div {BLOCK}), k -> slice(ordered_, 1 + k * {BLOCK}, {BLOCK}))"
    ends = "aggregate(b, array(0), (o, y) -> concat(o, array(greatest(element_at(o, -1), array_max(transform(y, x -> -x.e))))))"
    stretch = f"substring({text}, at + 1, greatest(array_max(transform(y, x -> -x.e)) - at, 0))"
    pieces = (
        "aggregate(y, named_struct('at', at, 'out', cast(array() AS ARRAY<STRING>)), (a, x) -> IF(x.s >= a.at, "
        "named_struct('at', -x.e, 'out', concat(a.out, array(substring(t, a.at - at + 1, x.s - a.at), concat('[', upper(x.kind), ']')))), "
        "named_struct('at', greatest(a.at, -x.e), 'out', a.out)), a -> array_join(a.out, ''))"
    )
    cut = f"zip_with(b, slice({ends}, 1, size(b)), (y, at) -> element_at(transform(array({stretch}), t -> {pieces}), 1))"
    last = "array_max(transform(ordered_, x -> -x.e))"
    new = F.expr(
        f"IF(size(ordered_) > 0, concat(element_at(transform(array({blocks}), b -> array_join({cut}, '')), 1), substring({text}, {last} + 1, length({text}))), {text})"
    )
    return found.withColumn(place, new).select(*names).toDF(*docs.columns)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document."""
    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), *[f"n_{kind}" for kind in BASE_KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("every")).alias("spans"))
