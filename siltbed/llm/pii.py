"""Personal data by proposals and boosted trees, in DataFrame functions throughout.

Four base rules (email, ip, card, phone) find what their formats prove. Two generators propose more, with
high recall and overlapping each other and the rules: anything like an address, and any run of seven or
more digits with marks between them. Boosted trees learn, on a bounded sample of proposals, which of them
are personal data, from their format and their context (the characters on both sides, telling words before).
Those that touch a base span are the positive cases, those whose format rules personal data out (``_none``)
the negative ones; all others have no label and are not learned from. The trees do not see what the base
rules ask for: the plus sign with its country code, brackets, spelt-out marks, the check digit and the range of parts are hidden.
A threshold for each generator is set so that ``RECALL`` of the proposals of all documents that touch a base
span are above it; proposals above it that touch none and are not ruled out are added. Base spans always stay.

The trees are written out as one SQL expression, so documents are scored where they lie: one row per
document, no shuffle, no Python.

Defined cases: a null text counts as empty and has no span; with proposals of one kind only, or none,
nothing is added; repeated rows and null ids are handled like others; an empty table gives no rows;
``redact`` keeps all other columns as they are.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import documents, stored, text_of

#: Proposals that are fitted, documents they come from, and the trees.
SAMPLE, SAMPLE_DOCUMENTS, TREES, DEPTH = 6000, 40_000, 10, 4
RECALL = 0.98

KINDS = ["email", "ip", "card", "phone"]
ADDED = ["like_email", "like_number"]

# Possessive forms of the base rules: each repeated part ends where its characters end, so giving
# characters back never helps, and long runs cost one step per character and no stack. A word or number
# is entered at its first character, or where the last match ended.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_LIKE_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)*+"
_LIKE_NUMBER = r"\+?\(?[0-9](?:[\x20().-]{0,3}+[0-9]){6,}+"

_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9]?)"
_IN_RANGE = rf"^{_PART}(?:\.{_PART}){{3}}$"
_SPAN = "array<struct<start:int,end:int,m:string>>"


def _empty() -> Column:
    return F.array().cast(_SPAN)


def matches(text: Column, pattern: str, possible: Column) -> Column:
    """(start, end, m) of all matches, leftmost and not overlapping, in code points. The places follow from
    the lengths of the pieces between matches. ``possible`` is a cheap test that any match passes."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))
    zero = F.struct(F.lit(0).alias("at"), _empty().alias("out"))

    def add(a: Column, x: Column) -> Column:
        start = a["at"] + x["gap"]
        end = start + F.length(x["m"])
        one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m"))
        return F.when(x["m"].isNull(), a).otherwise(F.struct(end.alias("at"), F.concat(a["out"], F.array(one)).alias("out")))

    return F.when(possible, F.aggregate(steps, zero, add, lambda a: a["out"])).otherwise(_empty())


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether the last digit checks, for 14 to 19 digits."""
    d = F.reverse(digits(m))
    n = F.length(d)

    def value(i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda a, i: a + F.coalesce(value(i), F.lit(0)))
    return F.when(n.between(14, 19), total % 10 == 0).otherwise(F.lit(False))


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_email`` to ``_phone``: the spans of the base rules."""
    t = F.col(text)
    return docs.withColumns(
        {
            "_email": matches(t, _EMAIL, t.contains("@")),
            "_ip": F.filter(matches(t, _IP, t.rlike(r"[0-9]\.[0-9]++\.[0-9]")), lambda s: s["m"].rlike(_IN_RANGE)),
            "_card": F.filter(matches(t, _CARD, t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}")), lambda s: luhn(s["m"])),
            "_phone": F.filter(matches(t, _PHONE, t.contains("+")), lambda s: F.length(digits(s["m"])).between(10, 15)),
        }
    )


def _plain(m: Column) -> Column:
    """A proposal with spelt-out marks as they are meant."""
    return F.regexp_replace(F.regexp_replace(m, r"\x20?(?:@|\(at\)|\[at\])\x20?", "@"), r"\x20?(?:\(dot\)|\[dot\])\x20?", ".")


def _features(text: Column, s: Column) -> dict[str, Column]:
    """What the trees see of a proposal: its format, without the marks that the base rules ask for, and its
    context."""
    m, one = F.regexp_replace(_plain(s["m"]), r"^\+(?:[0-9]{1,3}[\x20().-]+)?|[+()]", ""), F.lit(1)
    count = lambda pattern: F.length(m) - F.length(F.regexp_replace(m, pattern, ""))
    before = F.when(s["start"] > 0, F.substring(text, s["start"], one)).otherwise(F.lit(""))
    after = F.substring(text, s["end"] + 1, one)
    lead = F.lower(F.substring(text, F.greatest(s["start"] - 23, F.lit(1)), F.least(s["start"], F.lit(24))))
    return {
        "size": F.length(m),
        "digits": F.length(digits(m)),
        "dots": count(r"\."),
        "spaces": count(r"\x20"),
        "dashes": count("-"),
        "letters": count("[A-Za-z]"),
        "glued": before.rlike("[A-Za-z0-9]").cast("int") + after.rlike("[A-Za-z0-9]").cast("int"),
        "quoted": before.rlike("[\"'=:#/]").cast("int"),
        "told": lead.rlike(r"(?:phone|tel|call|fax|mail|card|visa|account|contact|address|ssn|iban)[^a-z]").cast("int"),
    }


FEATURES = ["size", "digits", "dots", "spaces", "dashes", "letters", "glued", "quoted", "told"]


def _none(kind: int, text: Column, s: Column) -> Column:
    """Whether a proposal's format rules personal data out: an address without a named top domain; a number
    within a word, a decimal number, a date, four parts beyond their range, too many digits for anything, or
    too many for a phone while the check digit is wrong."""
    m = s["m"]
    if kind == 0:
        return ~_plain(m).rlike(r"@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}$")
    before = F.when(s["start"] > 0, F.substring(text, s["start"], F.lit(1))).otherwise(F.lit(""))
    within = before.rlike("[A-Za-z]") | F.substring(text, s["end"] + 1, F.lit(1)).rlike("[A-Za-z]")
    date = m.rlike(r"^(?:19|20)[0-9]{2}([.-])[0-9]{1,2}\1[0-9]{1,2}(?:\x20|$)")
    parts = m.rlike(r"^[0-9]+(?:\.[0-9]+){3}$") & ~m.rlike(_IN_RANGE)
    n = F.length(digits(m))
    return within | m.rlike(r"^[0-9]+\.[0-9]+$") | date | parts | (n > 19) | ((n > 15) & ~luhn(m))


def _touches(spans: Column, s: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


def _all_base() -> Column:
    return F.concat(*(F.col(f"_{k}") for k in KINDS))


def with_proposals(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_proposed``: (kind, start, end, known, none, features) for each proposal; ``known`` tells
    whether it touches a base span, ``none`` whether it touches none and is ruled out."""
    t = F.col(text)
    found = {
        "_like_email": matches(t, _LIKE_EMAIL, t.rlike(r"@|\(at\)|\[at\]")),
        "_like_number": matches(t, _LIKE_NUMBER, t.rlike(r"[0-9](?:[\x20().-]{0,3}[0-9]){6}")),
    }

    def described(kind: int) -> Column:
        def one(s: Column) -> Column:
            f = F.struct(*(v.cast("double").alias(k) for k, v in _features(t, s).items()))
            known = _touches(_all_base(), s)
            return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), known.alias("known"), (~known & _none(kind, t, s)).alias("none"), f.alias("f"))

        return F.transform(F.col(f"_{ADDED[kind]}"), one)

    return docs.withColumns(found).withColumn("_proposed", F.concat(described(0), described(1)))


# -- trees -------------------------------------------------------------------------------------------


def _tree(lines: list[str], s: Column) -> Column:
    """The SQL form of one printed tree; takes its lines from the front."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return F.lit(float(line.split(":")[1]))
    feature, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = _tree(lines, s)
    lines.pop(0)
    return F.when(s["f"][FEATURES[int(feature)]] <= float(bound), low).otherwise(_tree(lines, s))


def margin(model, s: Column) -> Column:
    """The weighted sum of all trees for the proposal ``s``."""
    total = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights):
        lines = [x for x in tree.toDebugString.splitlines()[1:] if x.strip()]
        total = total + F.lit(float(weight)) * _tree(lines, s)
    return total


def learn(docs: DataFrame) -> tuple[object, list[float]] | None:
    """The trees, and each generator's least margin; None where there is nothing to learn from. The labelled
    proposals come from documents chosen by a hash, about ``SAMPLE_DOCUMENTS`` of them; the margins are set
    on all documents."""
    whole = text_of(docs)
    cut = int(min(1.0, SAMPLE_DOCUMENTS / max(docs.count(), 1)) * (1 << 30))
    some = whole.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < cut)
    proposed = with_proposals(with_base(some)).select("doc_id", F.explode("_proposed").alias("p")).where("p.known or p.none")
    order = F.xxhash64("doc_id", "p.start", "p.end", "p.kind")
    rows = proposed.select(order.alias("order"), "p.kind", "p.known", "p.f.*").orderBy("order", "kind").limit(SAMPLE)
    fit = stored(rows.withColumn("y", F.col("known").cast("double")), "proposals")
    if fit.select("y").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="v")
    trees = GBTClassifier(featuresCol="v", labelCol="y", maxIter=TREES, maxDepth=DEPTH, seed=7, cacheNodeIds=False)
    model = trees.fit(vectors.transform(fit))
    known = with_proposals(with_base(whole)).select(F.explode(F.filter("_proposed", lambda p: p["known"])).alias("p"))
    # At most a few hundred different margins, each with its count.
    counts = known.select("p.kind", F.round(margin(model, F.col("p")), 2).alias("margin")).groupBy("kind", "margin").agg(F.count("*").alias("n")).collect()
    bars = []
    for kind in range(len(ADDED)):
        own = sorted((r for r in counts if r.kind == kind), key=lambda r: -r.margin)
        bar, n = float("inf"), 0
        for r in own:
            if n < RECALL * sum(x.n for x in own):
                bar, n = r.margin, n + r.n
        bars.append(bar)
    return model, bars


def with_spans(docs: DataFrame, learned: tuple | None, text: str = "text") -> DataFrame:
    """Adds the base columns and ``_spans``: (start, rank, end) of all spans in order; ``rank`` counts
    KINDS and then ADDED."""
    based = with_base(docs, text)

    def span(rank: int):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"))

    lists = [F.transform(F.col(f"_{k}"), span(i)) for i, k in enumerate(KINDS)]
    based = based.withColumn("_base", F.array_sort(F.concat(*lists)))
    if learned is None:
        return based.withColumn("_spans", F.col("_base"))
    model, bars = learned
    scored = with_proposals(based, text)

    def good(kind: int):
        return lambda s: (s["kind"] == kind) & ~s["known"] & ~s["none"] & (margin(model, s) >= bars[kind] - 0.005)

    extra = [F.transform(F.filter("_proposed", good(k)), span(len(KINDS) + k)) for k in range(len(bars)) if bars[k] < float("inf")]
    return scored.withColumn("_spans", F.array_sort(F.concat("_base", *extra)))


def _written(spans: str) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS + ADDED))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ",")


def redact(docs: DataFrame, learned: tuple | None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; ``n_chars``, where there is
    one, counts the new text. A null text stays null."""
    # The rows stay apart as one column, so that no name of theirs meets one used here.
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    found = with_spans(whole, learned, "_text")
    marks = F.array(*(F.lit(f"[{k.removeprefix('like_').upper()}]") for k in KINDS + ADDED))
    t = F.col("_text")

    def lay(a: Column, s: Column) -> Column:
        between = F.substring(t, a["at"] + 1, s["start"] - a["at"])
        out = F.when(s["start"] >= a["at"], F.concat(a["out"], between, F.element_at(marks, s["rank"] + 1))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), out.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.length(t)))
    changed = F.size("_spans") > 0
    out = found.withColumn("_new", F.when(changed, F.aggregate("_spans", zero, lay, rest)))

    def column(name: str) -> Column:
        old = F.col("_row")[name]
        if name == "text":
            return F.coalesce("_new", old)
        if name == "n_chars":
            return F.coalesce(F.length("_new").cast(docs.schema[name].dataType), old)
        return old

    return out.select(*(column(c).alias(c) for c in docs.columns))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = with_spans(text_of(docs), learn(docs))
    counts = [F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_written("_base"), 256).alias("base_sha256"), _written("_spans").alias("spans"))
