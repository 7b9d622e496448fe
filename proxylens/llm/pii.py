"""Personal data by candidate gradient boosting, with DataFrame functions only.

Base rules find well-formed e-mail addresses, IPv4 addresses, card and phone numbers. Looser generators
propose further spans, which may overlap. Gradient-boosted trees judge a proposal by its format and its
surroundings; the trees become plain column expressions. A proposal is taken where its probability is
above the threshold of its kind and it overlaps no base span and no proposal taken of a kind listed before.

Training takes about `sample` proposals at most, by a hash over all documents. A proposal is a positive where
it passes the base rule of its kind, and so is the same value written otherwise (`at` and `dot` in words,
other separators, no plus sign) in the same surroundings. Proposals that fail the rule and touch no base
span are negatives, and so are decoys: plain words around `at` and `dot`, lists of numbers, broken card
numbers and dates in the surroundings of a positive. Thresholds are calibrated on all proposals that the
trees were not fitted on: the least probability from which on the share of positives is at least `precision`.

Positions are code points, ends exclusive. Surroundings reach to the next match of the same kind at most.
Texts, spans and numbers of spans of any size take time in proportion, but for the logarithm of their
number. Null text counts as empty and has no spans. Repeated rows and equal texts are searched each and get
the same spans; equal probabilities need no order. Empty input gives no rows. If the proposals are all of
one class, no span is added. Other columns, whatever their names, pass through `redact`; `pii_report` ignores them.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proxylens.llm.common import let, saved

KINDS = ("email", "ip", "card", "phone")
LOCAL, LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: Base rules. The heads keep a search linear in long runs: a match starts where a run does or where the last match ended.
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{LABEL}]++(?:\.[{LABEL}]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to occur.
SIGN = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9]", "phone": "\\+[0-9]"}
PROPOSE = {
    "email": rf"(?i)(?<![{LOCAL}])[{LOCAL}]++(?:@| ?(?:\(at\)|\[at\]|\{{at\}}) ?| at )[{LABEL}]++(?:(?:\.| ?(?:\(dot\)|\[dot\]|\{{dot\}}) ?| dot )[{LABEL}]++)++",
    "ip": r"(?i)(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|[.,-]) ?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9])\(?[0-9]{2,4}\)?[ ./-]{0,2}[0-9]{2,4}[ ./-]{0,2}[0-9]{3,4}(?:[ ./-][0-9]{1,4})?(?![0-9])",
}
#: What a text must hold for a proposal of a kind.
HINT = {"email": r"(?i)@|[({\[]at[)}\]]| at ", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
OCTET = "^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"
#: Words that stand before personal data.
CUES = "(?i)(mail|contact|call|phone|tel|fax|mobile|card|visa|payment|address|host|server|ip)[^A-Za-z]{0,6}$"
#: How most host names end.
NAMES = "(?i)[.\\] )}](com|org|net|edu|gov|int|io|info|biz|de|fr|es|uk|eu|us|jp|cn|ru|it|nl|ch|at|be|pl|se)$"
SAMPLE, PRECISION, TREES, DEPTH, BINS = 20_000, 0.995, 12, 4, 50


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    d = F.reverse(digits)
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), lambda i: let(F.coalesce(F.try_element_at(F.split(d, ""), i).try_cast("int"), F.lit(0)), lambda x: F.when(i % 2 == 1, x).when(x > 4, 2 * x - 9).otherwise(2 * x)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The check of a kind's base rule on a match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, "\\."), lambda part: part.rlike(OCTET))
    if kind == "card":
        return let(digits_of(value), lambda d: F.length(d).between(12, 19) & luhn(d))
    return F.length(digits_of(value)).between(9, 15)


SPAN = "array<struct<start:int,rank:int,end:int,value:string,before:string,after:string>>"
#: Arrays are summed up in blocks of BLOCK values, the blocks in blocks, and so on LEVELS times; beyond BLOCK**(LEVELS + 1) values the last level takes longer.
BLOCK, LEVELS = 64, 3


def running(values: Column, both, levels: int = LEVELS) -> Column:
    """both(), which has 0 as its neutral value, of each value and all before it."""

    def fold(v: Column, low: Column, n: Column) -> Column:
        return F.aggregate(F.slice(v, low + 1, n), F.lit(0), lambda a, b: both(a, b))

    def plain(v: Column) -> Column:
        return F.transform(v, lambda x, i: fold(v, F.lit(0), i + 1))

    def in_blocks(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda j: fold(v, j * BLOCK, F.lit(BLOCK)))
        return let(running(blocks, both, levels - 1), lambda before: F.transform(v, lambda x, i: let(F.floor(i / BLOCK).cast("int"), lambda j: both(fold(v, j * BLOCK, i - j * BLOCK + 1), F.when(j > 0, F.get(before, j - 1)).otherwise(0)))))

    return let(values, lambda v: F.when(F.size(v) > BLOCK, in_blocks(v)).otherwise(plain(v)) if levels else plain(v))


def spans_of(text: Column, pattern: str, rank: int, check) -> Column:
    """array of SPAN: the non-overlapping matches of pattern that pass check, with what stands around them."""
    none = F.array().cast(SPAN)

    def place(m: Column, gaps: Column) -> Column:
        steps = F.transform(m, lambda x, i: F.length(x) + F.length(F.get(gaps, i)))
        found = let(running(steps, lambda a, b: a + b), lambda ends: F.transform(m, lambda x, i: F.struct((F.get(ends, i) - F.length(x)).alias("start"), F.lit(rank).alias("rank"), F.get(ends, i).alias("end"), x.alias("value"), F.right(F.get(gaps, i), F.lit(24)).alias("before"), F.substring(F.get(gaps, i + 1), 1, 8).alias("after"))))
        return F.filter(found, lambda s: check(s["value"]))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, let(F.split(text, pattern, -1), lambda gaps: place(m, gaps))).otherwise(none))


def base_spans(text: Column) -> Column:
    return F.concat(*[F.when(text.rlike(SIGN[k]), spans_of(text, BASE[k], rank, lambda v, k=k: valid(k, v))).otherwise(F.array().cast(SPAN)) for rank, k in enumerate(KINDS)])


def proposals(text: Column, kind: str) -> Column:
    return F.when(text.rlike(HINT[kind]), spans_of(text, PROPOSE[kind], KINDS.index(kind), lambda v: F.lit(True))).otherwise(F.array().cast(SPAN))


def features(rank: Column, value: Column, before: Column, after: Column) -> Column:
    """array<double> of what the trees see."""
    count = lambda chars: F.length(F.regexp_replace(value, f"[^{chars}]", ""))
    digits = digits_of(value)
    parts = F.split(F.trim(F.regexp_replace(value, "[^0-9]+", " ")), " ")
    flags = [F.length(digits), F.length(value), count("A-Za-z"), count(" "), count("(){}.\\[\\]_/-"), F.size(parts), F.forall(parts, lambda p: p.rlike(OCTET)), F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False), value.contains("@"), value.rlike("(?i)[({\\[]at[)}\\]]"), value.rlike("(?i) at "), value.rlike("(?i)[({\\[]dot[)}\\]]"), value.rlike("(?i) dot "), value.contains("("), before.endswith("+"), before.rlike("[A-Za-z0-9_.]$"), after.rlike("^[A-Za-z0-9_]"), before.rlike(CUES), value.rlike("[.] "), value.rlike(NAMES), value.rlike("^[A-Za-z]*[0-9._+-][A-Za-z0-9._+-]* ?[@(\\[{a]"), value.contains(","), value.rlike("[\\[(][.]")]
    return F.array(*[(rank == r).cast("double") for r in range(len(KINDS))], *[f.cast("double") for f in flags])


def tree_columns(debug: str, f) -> Column:
    """The margin of boosted trees from their printed form; f(i) is the i-th feature."""
    lines = debug.splitlines()
    total, at = F.lit(0.0), 0

    def node() -> Column:
        nonlocal at
        line = lines[at].strip()
        at += 1
        if line.startswith("Predict"):
            return F.lit(float(line.split(":")[1]))
        i, cut = re.match(r"If \(feature (\d+) <= ([-\d.E]+)\)", line).groups()
        low = node()
        at += 1  # the line of Else
        return F.when(f(int(i)) <= float(cut), low).otherwise(node())

    while at < len(lines):
        head = re.match(r"\s*Tree \d+ \(weight ([-\d.E]+)\)", lines[at])
        at += 1
        if head:
            total = total + float(head[1]) * node()
    return total


def varied(labelled: DataFrame) -> DataFrame:
    """Positives in other spellings beside all rows of rank, value, before, after, y."""
    good = labelled.where("y = 1")
    v, r = F.col("value"), F.col("rank")
    spelled = F.when(r == 0, F.regexp_replace(F.regexp_replace(v, "@", " at "), "\\.(?=[A-Za-z0-9-]+$)", " dot ")).when(r == 1, F.regexp_replace(v, "\\.", "[.]")).when(r == 2, F.regexp_replace(digits_of(v), "(?<=^(....){1,4})(?=.)", ".")).otherwise(F.regexp_replace(v, "[ ()-]+", "."))
    bracketed = F.when(r == 0, F.regexp_replace(F.regexp_replace(v, "@", " [at] "), "\\.(?=[A-Za-z0-9-]+$)", " [dot] ")).when(r == 1, F.regexp_replace(v, "\\.", "(.)")).when(r == 2, F.regexp_replace(digits_of(v), "(?<=^(....){1,4})(?=.)", "/")).otherwise(F.regexp_replace(v, "^\\+?[0-9]{0,2} ?", ""))
    words = F.split(F.concat_ws(" ", "before", "after"), "[^A-Za-z]+")
    word = lambda i, other: F.coalesce(F.when(F.length(F.try_element_at(words, F.lit(i))) > 0, F.try_element_at(words, F.lit(i))), F.lit(other))
    d = digits_of(v)
    list_of = lambda sep: F.regexp_replace(v, "\\.", sep)
    off = F.concat(F.substring(d, 1, 3), (F.substring(d, 4, 1).try_cast("int") + 1) % 10, F.substring(d, 5, 20))
    decoys = [F.when(r == 0, F.concat(word(1, "look"), F.lit(a), word(-2, "shop"), F.lit(b), word(-1, "then"))).when(r == 1, list_of(c)).when(r == 2, F.regexp_replace(off, "(?<=^(....){1,4})(?=.)", e)).otherwise(F.concat_ws(g, F.substring(d, 1, 2), F.substring(d, 3, 2), F.substring(d, 5, 4))) for a, b, c, e, g in ((" at ", " dot ", ",", ".", "-"), (" at ", ".", "-", "/", "/"))]
    # names without dots and digits, where only the brackets tell
    name, host = F.regexp_replace(F.substring_index(v, "@", 1), "[^A-Za-z]", ""), F.substring_index(v, "@", -1)
    named = good.where((r == 0) & (F.length(name) > 0))
    plainly = [named.withColumn("value", F.concat(name, F.lit(" (at) "), host)), named.withColumn("value", F.concat(name, F.lit(" [at] "), F.regexp_replace(host, "\\.(?=[A-Za-z0-9-]+$)", " [dot] "))), named.withColumn("value", F.concat(name, F.lit("(at)"), host))]
    return reduce(DataFrame.union, [labelled, good.withColumn("value", spelled), good.withColumn("value", bracketed), *plainly, *(good.withColumn("value", x).withColumn("y", F.lit(0.0)) for x in decoys)])


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others, in order of their ends."""
    asked = F.transform(spans, lambda s: F.struct(s["end"].alias("at"), F.lit(0).alias("side"), F.lit(0).alias("reach"), s.alias("s")))
    known = F.transform(others, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("side"), b["end"].alias("reach"), b.alias("s")))

    def sweep(e: Column) -> Column:
        # the furthest end of the others that begin before a span's end
        reached = let(running(F.transform(e, lambda x: x["reach"]), F.greatest), lambda far: F.transform(e, lambda x, i: F.struct((F.get(far, i) <= x["s"]["start"]).alias("free"), x["side"].alias("side"), x["s"].alias("s"))))
        return F.transform(F.filter(reached, lambda x: (x["side"] == 0) & x["free"]), lambda x: x["s"])

    return F.when((F.size(spans) > 0) & (F.size(others) > 0), let(F.array_sort(F.concat(asked, known)), sweep)).otherwise(spans)


def labelled_proposals(docs: DataFrame) -> DataFrame:
    """h, rank, value, before, after, y (whether the base rule of the kind passes) of all base spans and free proposals."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    every = texts.withColumn("base", base_spans(F.col("text"))).withColumn("wide", F.concat(*[proposals(F.col("text"), k) for k in KINDS]))
    rows = every.withColumn("free", apart(F.col("wide"), F.col("base"))).select(F.explode(F.concat("base", "free")).alias("s")).select("s.rank", "s.value", "s.before", "s.after").distinct()
    passes = reduce(lambda c, k: c.when((F.col("rank") == k[0]) & F.regexp_replace(F.col("value"), BASE[k[1]], "").eqNullSafe(""), valid(k[1], F.col("value"))), enumerate(KINDS), F.when(F.lit(False), F.lit(False))).otherwise(False)
    return rows.select(F.xxhash64("rank", "value", "before", "after").alias("h"), "rank", "value", "before", "after", passes.cast("double").alias("y"))


def train(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION):
    """(probability of features, threshold by rank), or None where there is nothing to learn."""
    found = saved(labelled_proposals(docs), "pii-proposals")
    share = min(1.0, sample / max(found.count(), 1))
    fitting = (F.pmod("h", F.lit(3)) > 0) & (F.pmod(F.shiftright("h", 20), F.lit(1 << 20)) < int(share * (1 << 20)))
    table = varied(found.withColumn("fitting", fitting)).withColumn("f", features(F.col("rank"), F.col("value"), F.col("before"), F.col("after")))
    table = saved(table.select("fitting", "rank", "y", "f"), "pii-features")
    rows, held = table.where("fitting"), table.where("not fitting")
    if rows.select("y").distinct().count() < 2:
        return None
    model = GBTClassifier(labelCol="y", featuresCol="v", maxIter=TREES, maxDepth=DEPTH, seed=3).fit(rows.select("y", array_to_vector("f").alias("v")).coalesce(1))
    debug = model.toDebugString

    def probability(f: Column) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * tree_columns(debug, lambda i: F.get(f, F.lit(i)))))

    bins = held.groupBy("rank", F.least(F.floor(probability(F.col("f")) * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.sum("y").alias("good"), F.count("*").alias("n")).collect()  # 4 * BINS rows at most
    limits = {}
    for rank in range(len(KINDS)):
        own, good, n = {r.bin: r for r in bins if r["rank"] == rank}, 0.0, 0
        for b in range(BINS - 1, BINS // 2 - 1, -1):
            if b in own:
                good, n = good + own[b].good, n + own[b].n
                if n and good / n >= precision:
                    limits[rank] = b / BINS
    return probability, limits


def with_spans(docs: DataFrame, model) -> DataFrame:
    """_row (the input's columns), text, base, spans: arrays of SPAN in order; model as train gives it."""
    found = docs.select(F.struct("*").alias("_row"), F.coalesce("text", F.lit("")).alias("text"))
    found = found.withColumn("base", F.array_sort(base_spans(F.col("text")))).withColumn("spans", F.col("base"))
    probability, limits = model or (None, {})
    for rank, limit in sorted(limits.items()):
        sure = F.filter(proposals(F.col("text"), KINDS[rank]), lambda s: let(features(s["rank"], s["value"], s["before"], s["after"]), probability) >= limit)  # noqa: B023
        found = found.withColumn("sure", sure)
        found = found.withColumn("spans", F.concat("spans", apart(F.col("sure"), F.col("spans"))))
    return found.select("_row", "text", "base", F.array_sort("spans").alias("spans"))


def find_spans(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION) -> DataFrame:
    """_row (the input's columns), text, base, spans: arrays of SPAN in order."""
    return with_spans(docs, train(docs, sample, precision))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")


def pii_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (of the base rules), base_sha256, spans (all), n_added."""
    found = find_spans(docs.select("doc_id", "text"), **options)
    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{k}") for rank, k in enumerate(KINDS)]
    return found.select("_row.doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def redact(docs: DataFrame, **options) -> DataFrame:
    """docs with each span of text replaced by its kind in brackets; of overlapping spans the first stands for all."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    found = find_spans(docs, **options).withColumn("letters", F.when(F.size("spans") > 0, F.split("text", "")))  # code points
    found = found.withColumn("reach", running(F.transform("spans", lambda s: s["end"]), F.greatest))
    plain = lambda low, high: F.array_join(F.slice("letters", low + 1, F.greatest(high - low, F.lit(0))), "")
    since = lambda i: F.when(i > 0, F.get("reach", i - 1)).otherwise(0)
    parts = F.transform("spans", lambda s, i: F.when(s["start"] >= since(i), F.concat(plain(since(i), s["start"]), F.get(names, s["rank"]))).otherwise(""))
    whole = F.when(F.size("spans") > 0, F.concat(F.array_join(parts, ""), plain(F.element_at("reach", -1), F.size("letters")))).otherwise(F.col("text"))
    new = F.when(F.col("_row")["text"].isNotNull(), whole)
    return found.select(*[new.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
