"""Personal data: candidate spans of high recall, judged by gradient-boosted trees.

Fixed rules give the base spans. Looser generators propose further spans, which may
overlap each other; boosted trees score them by their form and their surroundings, and a
threshold per kind, calibrated for ``PRECISION``, selects what is redacted besides the
base. The trees learn from the rules: a proposal that is a base span is right, others are
wrong, and those that touch further digits, where the rules are blind, are not learnt
from.

All of it is column expressions: a table is scanned once to gather all proposals for the
fit, of which equal ones become one with a weight, and once to find the spans, without a
shuffle. The fitted trees are written out as conditions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import stored

TREES = 10
DEPTH = 3
PRECISION = 0.95
NEAR = 16
KINDS = ("email", "ip", "card", "phone")

# The rules, possessive where that changes no match: long runs then need no stack and are
# read once. An email's local part begins where its run of characters or the search does.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What else may be one.
PROPOSED = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z0-9-]{2,63}+)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:[.,][0-9]{1,3}+){3}+(?![.]?[0-9])",
    "card": r"(?<![0-9])[0-9]{4}+(?:[\x20.-]?[0-9]{4}){2,3}+(?:[\x20.-]?[0-9]{1,3}+)?+(?![0-9])",
    "phone": r"(?<![0-9])\+?[0-9]{1,3}+[\x20.-]?\(?[0-9]{2,4}+\)?[\x20.-]?[0-9]{3,4}+[\x20.-][0-9]{3,4}+(?![0-9])",
}
_HINTS = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|host|server|addr",
    "card": r"(?i)card|visa|pay",
    "phone": r"(?i)tel|phone|call|fax|mobil",
}
# What a text must hold for any match: cheap to look for, and true of every match.
_BASE_MUST = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_PROPOSED_MUST = {"email": r"@|\bat\b", "ip": r"[0-9][.,][0-9]", "card": "[0-9]{4}", "phone": "[0-9]{3}"}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    digits = F.reverse(_digits(value))
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: (
        F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
    ))
    total = F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return F.when(F.length(digits) > 0, total % 10 == 0).otherwise(False)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.concat(F.lit("0"), F.substring(p, 1, 3)).cast("int") <= 255))
    if kind == "card":
        return luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _valid_span(kind: str) -> Callable[[Column], Column]:
    return lambda span: _valid(kind, span["value"])


def _as_kind(number: int) -> Callable[[Column], Column]:
    return lambda s: F.struct(F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))


def _running_sum(numbers: Column) -> Column:
    """Sums of the array up to each place, by doubling strides, in k log k steps."""
    zeros = lambda n: F.array_repeat(F.lit(0), n)
    strides = F.transform(F.sequence(F.lit(0), F.lit(30)), lambda j: F.pow(F.lit(2), j).cast("int"))
    used = F.filter(strides, lambda d: d < F.size(numbers))

    def add(sums: Column, stride: Column) -> Column:
        shifted = F.concat(zeros(stride), F.slice(sums, F.lit(1), F.size(sums) - stride))
        return F.zip_with(sums, shifted, lambda a, b: a + b)

    return F.aggregate(used, numbers, add)


def _spans(found: str, between: str) -> Column:
    """``(start, end, value)`` in characters of the matches ``found``, from the texts between them."""
    lengths = F.transform(found, lambda x: F.length(x))
    ahead = F.transform(F.slice(between, 1, F.size(found)), lambda x: F.length(x))
    steps = F.zip_with(ahead, F.slice(F.concat(F.array(F.lit(0)), lengths), 1, F.size(found)), lambda a, b: a + b)

    def place(start: Column, value: Column) -> Column:
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"))

    return F.zip_with(_running_sum(steps), found, place)


def _with_matches(df: DataFrame, patterns: dict[str, str], must: dict[str, str], prefix: str) -> DataFrame:
    """For each kind a column of its matches' spans; ``must`` holds for every text with a match."""
    none = F.array().cast("array<string>")
    found = {
        f"__{prefix}_{k}": F.when(F.col("text").rlike(must[k]), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none)
        for k, p in patterns.items()
    }
    df = df.withColumns(found)
    df = df.withColumns({
        f"__{prefix}_{k}_between": F.when(F.size(f"__{prefix}_{k}") > 0, F.split("text", p, -1)).otherwise(none)
        for k, p in patterns.items()
    })
    df = df.withColumns({f"{prefix}_{k}": _spans(f"__{prefix}_{k}", f"__{prefix}_{k}_between") for k in patterns})
    return df.drop(*(f"__{prefix}_{k}{s}" for k in patterns for s in ("", "_between")))


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), and per kind the base spans, ``base_<kind>``."""
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    found = _with_matches(plain, BASE, _BASE_MUST, "base")
    return found.withColumns({
        f"base_{k}": F.filter(f"base_{k}", _valid_span(k)) for k in KINDS
    })


FEATURES = (
    "length", "digits", "groups", "longest", "separators", "plus", "parentheses", "luhn", "at", "letters",
    "small_parts", "hint", "line_start", "email", "ip", "card", "phone",
)


def _features(kind: str, value: Column, before: Column) -> Column:
    runs = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))
    parts = {
        "length": F.length(value),
        "digits": F.length(_digits(value)),
        "groups": F.size(runs),
        "longest": F.coalesce(F.array_max(F.transform(runs, lambda r: F.length(r))), F.lit(0)),
        "separators": F.length(F.regexp_replace(value, r"[^\x20.,-]", "")),
        "plus": F.startswith(value, F.lit("+")),
        "parentheses": F.contains(value, F.lit("(")),
        "luhn": luhn(value),
        "at": F.contains(value, F.lit("@")),
        "letters": F.length(F.regexp_replace(value, "[^A-Za-z]", "")),
        "small_parts": F.forall(runs, lambda r: (F.length(r) <= 3) & (F.substring(r, 1, 3).cast("int") <= 255)),
        "hint": before.rlike(_HINTS[kind]),
        "line_start": before.rlike(r"(^|\n)$"),
        **{k: F.lit(k == kind) for k in KINDS},
    }
    return F.array(*(parts[name].cast("double") for name in FEATURES))


def with_proposals(found: DataFrame) -> DataFrame:
    """Adds ``proposals``: all kinds' proposed spans with features, whether the rules give
    the very span, and whether digits follow or precede."""
    df = _with_matches(found, PROPOSED, _PROPOSED_MUST, "proposed")
    every = [F.transform(f"proposed_{kind}", _described(number, kind)) for number, kind in enumerate(KINDS)]
    return df.withColumn("proposals", F.concat(*every)).drop(*(f"proposed_{k}" for k in KINDS))


def _described(number: int, kind: str) -> Callable[[Column], Column]:
    def described(s: Column) -> Column:
        from_ = F.greatest(F.lit(0), s["start"] - NEAR)
        before = F.substring("text", from_ + 1, s["start"] - from_)
        after = F.substring("text", s["end"] + 1, F.lit(NEAR))
        touching = before.rlike(r"[0-9][\x20().-]*$") | after.rlike(r"^[\x20().-]*[0-9]")
        same = F.exists(f"base_{kind}", lambda b: (b["start"] == s["start"]) & (b["end"] == s["end"]))
        return F.struct(
            F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            _features(kind, s["value"], before).alias("features"), same.alias("same"), touching.alias("touching"),
        )

    return described


@dataclass
class Trees:
    """Boosted trees as a column expression, and the least score that selects each kind."""

    nodes: list = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)

    def score(self, features: Column) -> Column:
        def value(node: tuple) -> Column:
            if len(node) == 1:
                return F.lit(node[0])
            index, limit, left, right = node
            return F.when(features[index] <= limit, value(left)).otherwise(value(right))

        total = F.lit(0.0)
        for weight, node in zip(self.weights, self.nodes):
            total = total + F.lit(weight) * value(node)
        return 1 / (1 + F.exp(-2 * total))


def _tree(node) -> tuple:
    if node.numDescendants() == 0:
        return (float(node.prediction()),)
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def train(docs: DataFrame) -> Trees | None:
    """Trees from the documents' own proposals; None where either sort is missing.

    Half of all proposals fits the trees, the other half calibrates the thresholds.
    """
    # One pass over the texts; proposals are few numbers each.
    lists = stored(with_proposals(with_base(docs)).select("doc_id", "proposals"), "proposals")
    proposals = lists.select("doc_id", F.explode("proposals").alias("p"))
    rows = proposals.where("NOT p.touching").select(
        F.col("p.features").alias("values"), "p.kind", F.col("p.same").cast("double").alias("label"),
        F.pmod(F.xxhash64(F.xxhash64("doc_id", "p.start", "p.kind"), F.lit(8)), F.lit(2)).alias("half"),
    )
    # Forms repeat: the fit reads each once, with the number of its proposals.
    forms = stored(rows.groupBy("half", "kind", "values", "label").agg(F.count(F.lit(1)).cast("double").alias("n")), "forms")
    fitting = forms.where("half = 0")
    if fitting.select("label").distinct().count() < 2:
        return None
    fitted = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH, seed=8, checkpointInterval=-1
    ).fit(fitting.select(array_to_vector("values").alias("features"), "label", "n"))
    trees = Trees([_tree(t._java_obj.rootNode()) if hasattr(t, "_java_obj") else _tree(t._call_java("rootNode")) for t in fitted.trees], list(fitted.treeWeights))
    scored = forms.where("half = 1").select("kind", "label", "n", F.round(trees.score(F.col("values")), 3).alias("score"))
    at = scored.groupBy("kind", "score").agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("all")).collect()
    for kind in range(len(KINDS)):
        own = sorted(((r["score"], r["right"], r["all"]) for r in at if r["kind"] == kind), reverse=True)
        least, right, every = 2.0, 0.0, 0
        for score, r, n in own:
            right, every = right + r, every + n
            if score >= 0.5 and right >= PRECISION * every:
                least = score
        trees.thresholds.append(least - 0.0005)
    return trees


def find(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """Per row: doc_id, text, the base spans per kind, and ``added``: spans the trees select
    besides, none overlapping a base span or a better one.

    Null texts are empty. Each row stands for itself, whatever its id. An empty table
    gives an empty result. Other columns are ignored.
    """
    found = with_base(docs)
    if trees is None:
        return found.withColumn("added", F.array().cast("array<struct<kind:int,start:int,end:int>>"))
    found = with_proposals(found)
    limits = F.array(*map(F.lit, trees.thresholds))
    base = F.concat(*(F.transform(f"base_{k}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS))
    apart = lambda a, b: (a["end"] <= b["start"]) | (b["end"] <= a["start"])
    found = found.withColumn("__base", base)
    loose = F.filter("proposals", lambda p: F.forall("__base", lambda b: apart(p, b)))
    scored = F.transform(loose, lambda p: F.struct(
        (-trees.score(p["features"])).alias("worse"), p["start"].alias("start"), p["end"].alias("end"), p["kind"].alias("kind")
    ))
    found = found.withColumn("__scored", scored)
    kept = F.array_sort(F.filter("__scored", lambda p: -p["worse"] >= F.element_at(limits, p["kind"] + 1)))
    found = found.withColumn("__kept", kept)
    best = F.aggregate(
        "__kept", F.array().cast("array<struct<kind:int,start:int,end:int>>"),
        lambda done, p: F.when(
            F.forall(done, lambda d: apart(d, p)),
            F.concat(done, F.array(F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))),
        ).otherwise(done),
    )
    return found.withColumn("added", best).drop("__base", "__scored", "__kept", "proposals")


def spans(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """Per row: doc_id, counts of base spans, a digest of them, and all spans as text."""
    found = find(docs, trees)
    base = F.concat(*(
        F.transform(f"base_{k}", _as_kind(n)) for n, k in enumerate(KINDS)
    ))
    names = F.array(*map(F.lit, KINDS))

    def listed(a: Column) -> Column:
        return F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id", *(F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.array_sort(F.concat(base, "added"))).alias("spans"),
    )


def redacted(docs: DataFrame, trees: Trees | None, mask: str = "[{}]") -> DataFrame:
    """``(doc_id, text)`` with every span replaced by its kind."""
    found = find(docs, trees)
    every = F.concat("added", *(
        F.transform(f"base_{k}", _as_kind(n)) for n, k in enumerate(KINDS)
    ))
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    masks = F.array(*(F.lit(mask.format(k)) for k in KINDS))
    empty = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    step = lambda done, s: F.struct(
        F.when(s["start"] >= done["at"], F.concat(done["text"], F.substring("text", done["at"] + 1, s["start"] - done["at"]), F.element_at(masks, s["kind"] + 1))).otherwise(done["text"]).alias("text"),
        F.greatest(done["at"], s["end"]).alias("at"),
    )
    end = F.aggregate(ordered, empty, step)
    tail = F.substring("text", end["at"] + 1, F.length("text"))
    return found.select("doc_id", F.concat(end["text"], tail).alias("text"))
