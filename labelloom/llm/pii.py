"""Personal data by scored candidates. DataFrame and SQL functions only (MLlib trains the trees).

High-recall generators propose spans that may overlap: the four base kinds (e-mail, IP, card, phone, each
with its own validity check) and three loose ones (``contact``: written-out e-mail, ``number``: long digit
groups, ``secret``: long mixed tokens). Each candidate gets format features (length, digits, letters,
separators, Luhn, dots) and context features (cue words and characters before and after). Gradient boosted
trees, trained on a bounded sample of weakly labelled candidates with a fair share for each kind, score them;
per kind, the lowest score at which all candidates of the table reach the wanted precision is the threshold.
Spans that pass are added to the base spans, which always stay.

Positions count code points, ends are exclusive. Spans are found inside a row: no join, no shuffle.

Cases: null or empty text has no spans; repeated rows give repeated results; an empty table, or a sample
without both labels, gives base spans only; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.session import table, written

BASE = ("email", "ip", "card", "phone")
LOOSE = ("contact", "number", "secret")
KINDS = BASE + LOOSE
#: At most so many candidates train the trees; thresholds and scoring cover all.
SAMPLE = 6000
PRECISION = 0.95
#: Thresholds are multiples of one over so many; a kind has at most so many counts.
STEPS = 10_000

# The patterns match what the plain forms match (greedy, leftmost, non-overlapping); possessive repeats and
# the look at the character before only keep a scan of long runs linear. \G: where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # runs of under 12 digits fail the check anyway
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "contact": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?[(\[{]at[)\]}]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[{]dot[)\]}])\x20?[A-Za-z0-9-]++)++",
    "number": r"[0-9](?:[\x20.()/-]{0,2}[0-9]){8,}+",
    # a run of any length; that it mixes letters and digits is a check of its own
    "secret": r"(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_/+=-]{20,}+",
}
#: A text without a match of this can't hold the kind.
NEEDS = {"email": "@", "phone": "+", "contact": "at"}

CUES = {
    "cue_secret": "(?i)(token|secret|passw|api|key|auth)[^A-Za-z]*$",
    "cue_contact": "(?i)(mail|contact|write to|tel|phone|call|fax|mobile)[^A-Za-z]*$",
    "cue_money": "(?i)(card|visa|iban|account|payment)[^A-Za-z]*$",
    "quoted": "[\"'=:]\\s*$",
}
FEATURES = ("length", "digits", "letters", "upper", "separators", "dots", "at", "luhn", "long_parts", *CUES, "word_before", "word_after", *(f"is_{k}" for k in KINDS))


def digits_of(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of ASCII digits passes the Luhn check."""
    n = F.length(digits)

    def weight(i: Column) -> Column:
        d = F.substring(digits, i, 1).cast("int")
        return F.when((n - i) % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    total = F.aggregate(F.transform(F.sequence(F.lit(1), n), weight), F.lit(0), lambda a, b: a + b)
    return F.when(n > 0, total % 10 == 0).otherwise(False)


def valid(kind: str, match: Column) -> Column:
    """The check of a base kind; a match that fails is dropped, not retried."""
    n = F.length(digits_of(match))
    if kind == "ip":
        # stripped of leading zeros, a part of more than three digits is over 255
        return F.forall(F.split(match, "\\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return n.between(12, 19) & luhn(digits_of(match))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    return F.lit(True)


def checked(kind: str, passes: bool):
    return lambda c: valid(kind, c["match"]) if passes else ~valid(kind, c["match"])


def found(text: Column, kind: str) -> Column:
    """Array of (kind, start, end, match, before, after) of all matches of a kind in ``text``.

    The pieces between the matches and the matches themselves alternate, so a running sum of their lengths
    gives the positions.
    """
    pattern = F.lit(PATTERNS[kind])
    pieces, matches = F.split(text, PATTERNS[kind], -1), F.regexp_extract_all(text, pattern, F.lit(0))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,match:string,before:string,after:string>>")

    def fold(both: Column) -> Column:
        def add(state: Column, i: Column) -> Column:
            piece, match = F.get(both["pieces"], i), F.get(both["matches"], i)
            start = state["at"] + F.length(piece)
            end = start + F.length(match)
            span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), match.alias("match"), F.right(piece, F.lit(24)).alias("before"), F.left(F.get(both["pieces"], i + 1), F.lit(4)).alias("after"))
            return F.struct(end.alias("at"), F.array_append(state["spans"], span).alias("spans"))

        start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
        return F.when(F.size(both["matches"]) == 0, none).otherwise(F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(both["matches"]) - 1, F.lit(0))), start, add, lambda s: s["spans"]))

    # a transform of one element binds both arrays to a variable: the text is split once
    spans = F.get(F.transform(F.array(F.struct(matches.alias("matches"), pieces.alias("pieces"))), fold), F.lit(0))
    has = F.contains(text, F.lit(NEEDS[kind])) & text.rlike(PATTERNS[kind]) if kind in NEEDS else text.rlike(PATTERNS[kind])
    return F.when(has, spans).otherwise(none)


def features(c: Column) -> dict[str, Column]:
    m, b, a = c["match"], c["before"], c["after"]
    count = lambda p: F.length(F.regexp_replace(m, p, "")).cast("double")
    d = digits_of(m)
    values = {
        "length": F.length(m).cast("double"),
        "digits": count("[^0-9]"),
        "letters": count("[^A-Za-z]"),
        "upper": count("[^A-Z]"),
        "separators": count("[A-Za-z0-9]"),
        "dots": count("[^.]"),
        "at": m.contains("@").cast("double"),
        "luhn": (F.length(d).between(12, 19) & luhn(d)).cast("double"),
        "long_parts": m.rlike("[0-9]{4,}").cast("double"),
        "word_before": b.rlike("[A-Za-z0-9]$").cast("double"),
        "word_after": a.rlike("^[A-Za-z0-9]").cast("double"),
    }
    values |= {k: b.rlike(p).cast("double") for k, p in CUES.items()}
    values |= {f"is_{k}": (c["kind"] == k).cast("double") for k in KINDS}
    return {k: F.coalesce(values[k], F.lit(0.0)) for k in FEATURES}


def with_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__base`` (valid base spans) and ``__more`` (other candidates)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs
    for kind in KINDS:
        out = out.withColumn(f"__{kind}", found(text, kind))
    base = F.concat(*[F.filter(F.col(f"__{k}"), checked(k, True)) for k in BASE])
    bad = [F.filter(F.col(f"__{k}"), checked(k, False)) for k in ("ip", "card", "phone")]
    loose = [F.filter(F.col(f"__{k}"), checked(k, True)) for k in LOOSE]
    out = out.withColumn("__base", base).withColumn("__more", F.concat(*bad, *loose))
    return out.drop(*[f"__{k}" for k in KINDS])


def weak_label(c: Column, base: Column) -> Column:
    """1 for a valid base span, a loose span that overlaps one, a written-out address or a token after a cue word."""
    inside = F.exists(base, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))
    cued = (c["kind"] == "secret") & c["before"].rlike(CUES["cue_secret"])
    return (inside | cued | (c["kind"] == "contact")).cast("int")


def tree_column(node, values: list[Column]) -> Column:
    """A trained regression tree as a column over the features ``values``."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    left, right = tree_column(node.leftChild(), values), tree_column(node.rightChild(), values)
    return F.when(values[split.featureIndex()] <= float(split.threshold()), left).otherwise(right)


class PiiModel:
    """Boosted trees as expressions, and a threshold for each kind (over 1: none is added)."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[str, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def score(self, values: dict[str, Column]) -> Column:
        if not self.trees:
            return F.lit(0.0)
        columns = [values[k] for k in FEATURES]
        margin = sum((tree_column(t, columns) * F.lit(w) for t, w in zip(self.trees, self.weights, strict=True)), F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-2.0 * margin))

    def selects(self, c: Column) -> Column:
        least = F.lit(2.0)
        for k, v in self.thresholds.items():
            least = F.when(c["kind"] == k, F.lit(v)).otherwise(least)
        return self.score(features(c)) >= least


def shares(counts: dict[str, int], sample: int) -> dict[str, int]:
    """How many of ``sample`` places each kind gets: equal parts, and what small kinds leave goes to the others."""
    out: dict[str, int] = {}
    for i, (kind, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[kind] = min(n, (sample - sum(out.values())) // (len(counts) - i))
    return out


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, precision: float = PRECISION) -> PiiModel:
    """Fit on at most ``sample`` candidates: the smallest of each kind by hash, so any rerun takes the same ones.

    Thresholds come from all candidates, those of the sample among them: a histogram of scores for each kind.
    """
    spans = with_candidates(docs.select(text_col), text_col)
    spans = spans.select("__base", F.explode(F.concat("__base", "__more")).alias("c"))
    rows = spans.select("c", weak_label(F.col("c"), F.col("__base")).alias("label"))
    rows = rows.select(F.col("c.kind").alias("kind"), "label", F.xxhash64("c").alias("h"), *[v.alias(k) for k, v in features(F.col("c")).items()])
    # a span that repeats in many copies of a text counts once
    rows = written(rows.dropDuplicates(["h"]), "pii-candidates")
    counts = {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [rows.filter(F.col("kind") == k).orderBy("h").limit(n) for k, n in sorted(shares(counts, sample).items()) if n]
    if not parts:
        return PiiModel([], [], {})
    picked = written(reduce(DataFrame.union, parts).coalesce(1), "pii-sample")
    if picked.select("label").distinct().count() < 2:
        return PiiModel([], [], {})
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=10, maxDepth=3, stepSize=0.3, seed=7, maxBins=32)
    model = gbt.fit(assembler.transform(picked))
    out = PiiModel([t._call_java("rootNode") for t in model.trees], list(model.treeWeights), dict.fromkeys(counts, 2.0))
    step = F.floor(out.score({k: F.col(k) for k in FEATURES}) * STEPS).cast("int")
    steps = rows.select("kind", "label", step.alias("step")).filter(F.col("step") >= STEPS // 2)
    by_kind: dict[str, list[tuple[int, int, int]]] = {}
    for r in steps.groupBy("kind", "step").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits")).collect():
        by_kind.setdefault(r["kind"], []).append((r["step"], r["n"], r["hits"]))
    for kind, bins in by_kind.items():
        seen, right = 0, 0
        for at, n, hits in sorted(bins, reverse=True):
            seen, right = seen + n, right + hits
            if right >= precision * seen:
                out.thresholds[kind] = at / STEPS - 1e-9
    return out


def find_pii(docs: DataFrame, model: PiiModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii_base`` and ``pii_spans``: sorted arrays of (start, rank, kind, end). Columns of these two
    names are replaced."""
    rank = {k: i for i, k in enumerate(KINDS)}

    def placed(c: Column) -> Column:
        order = F.lit(len(KINDS))
        for k, i in rank.items():
            order = F.when(c["kind"] == k, F.lit(i)).otherwise(order)
        return F.struct(c["start"].alias("start"), order.alias("rank"), c["kind"].alias("kind"), c["end"].alias("end"))

    # names of our own: the columns of docs may be called anything
    names = [c for c in docs.columns if c not in ("pii_base", "pii_spans")]
    own = [f"__c{i}" for i in range(len(names))]
    out = with_candidates(docs.select(*names).toDF(*own), own[names.index(text_col)])
    more = F.filter(F.col("__more"), model.selects)
    # a loose span inside a base span says nothing new; of equal spans one stays
    fresh = F.filter(more, lambda c: ~F.exists(F.col("__base"), lambda s: (s["start"] <= c["start"]) & (c["end"] <= s["end"])))
    out = out.withColumn("pii_base", F.array_sort(F.transform("__base", placed)))
    out = out.withColumn("pii_spans", F.array_sort(F.array_distinct(F.concat("pii_base", F.transform(fresh, placed)))))
    return out.select(*own, "pii_base", "pii_spans").toDF(*names, "pii_base", "pii_spans")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: PiiModel, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one.

    The columns stay as they are; ``n_chars``, if there, follows the new text. Null text stays null.
    """
    own = [f"__{i}" for i in range(len(docs.columns))]
    name = own[docs.columns.index(text_col)]
    text = F.col(name)
    out = find_pii(docs.toDF(*own), model, name)

    def step(state: Column, s: Column) -> Column:
        covered = s["start"] < state["at"]
        piece = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        parts = F.array_append(state["parts"], F.concat(piece, F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(covered, state["parts"]).otherwise(parts).alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    clean = F.aggregate("pii_spans", start, step, lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    hit = F.size("pii_spans") > 0
    out = out.withColumn(name, F.when(hit, clean).otherwise(text))
    if "n_chars" in docs.columns:
        size = own[docs.columns.index("n_chars")]
        out = out.withColumn(size, F.when(hit, F.length(name).cast(docs.schema["n_chars"].dataType)).otherwise(F.col(size)))
    return out.select(*own).toDF(*docs.columns)


def op6_pii_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = find_pii(docs, train(docs))
    count = lambda k: F.size(F.filter("pii_base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(F.col("pii_base")), 256).alias("base_sha256"), joined(F.col("pii_spans")).alias("spans"))


QUERIES = {"op6_pii_boosted": op6_pii_boosted}
ORACLE: dict[str, str] = {}
