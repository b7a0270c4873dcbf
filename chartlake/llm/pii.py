"""Personal data: fixed patterns, and spans that weak supervision adds.
DataFrame functions only.

Patterns find email, ip, card and phone spans. Digit strings are candidates for
further spans: five labelers (pattern, shape, gazetteer, context, grouping) vote
on each. Expectation-maximisation over the counts of the 32 vote patterns, taken
over all documents, estimates how reliable each labeler is; a logistic regression
trained on the resulting posteriors classifies the candidates. Counts of vote
patterns and of feature combinations are bounded tables whatever the input.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .logistic import sigmoid, train

KINDS = ("email", "ip", "card", "phone", "weak")
# A match can only start where a run of its first class starts, or right after the
# previous match; possessive repeats keep long runs linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){11,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
PARTS = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?(?:\.|$)){4}$"
CANDIDATE = r"(?<![0-9])(?<![0-9][ .()/-])\+?[0-9](?:[ .()/-]{0,2}+[0-9]){6,24}+(?![ .()/-]{0,2}[0-9])"
# Labelers of candidates; word lists in lower case.
SHAPE = r"^(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{4}(?:[ -][0-9]{4}){3})$"
GAZETTEER = ("(?:^|[^a-z])(?:phone|telephone|tel|mobile|cell|fax|ssn|passport|iban|account|card|visa|telefon|handy|"
             r"konto|ausweis|portable|compte|carte|movil|cuenta|tarjeta)[^a-z0-9]{0,4}(?:is |no|nr|number)?[^a-z0-9]{0,4}$")
CONTEXT = r"(?:call|contact|reach|my|your|numero|nummer|number|no|nr|id)[.:#]? ?[:#]? ?$"
VOTES, DIGITS, SEPARATORS = 5, 3, 3
FEATURES = VOTES + DIGITS + SEPARATORS + 1
SURE = 0.9


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def located(text: Column, pattern: str) -> Column:
    """Array of (start, end, txt, before) of all matches, in code points; before
    is the text since the last match. Starts are sums of the lengths before,
    added up by blocks of 64 matches."""
    empty = F.array().cast("array<struct<start: int, end: int, txt: string, before: string>>")
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)

    def place(x):
        lens = F.zip_with(x["g"], x["m"], lambda g, m: F.coalesce(F.length(g) + F.length(m), F.lit(0)))
        return let(lens, lambda ls: let(
            F.transform(F.sequence(F.lit(0), F.floor(F.size(ls) / 64).cast("int")),
                        lambda c: total(F.slice(ls, c * 64 + 1, 64))),
            lambda blocks: F.transform(x["m"], lambda m, i: let(
                total(F.slice(blocks, F.lit(1), F.floor(i / 64).cast("int")))
                + total(F.slice(ls, F.floor(i / 64).cast("int") * 64 + 1, i % 64))
                + F.length(F.get(x["g"], i)),
                lambda at: F.struct(at.alias("start"), (at + F.length(m)).alias("end"), m.alias("txt"),
                                    F.get(x["g"], i).alias("before"))))))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) == 0, empty)
               .otherwise(let(F.struct(m.alias("m"), F.split(text, pattern, -1).alias("g")), place)))


def digits_of(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(c: Column) -> Column:
    def doubled(d):
        return F.when(d > 4, 2 * d - 9).otherwise(2 * d)

    def digit(s, i):
        return F.substring(F.reverse(s), i + 1, F.lit(1)).cast("int")

    return let(digits_of(c), lambda s: F.aggregate(
        F.sequence(F.lit(0), F.length(s) - 1), F.lit(0),
        lambda t, i: t + F.when(i % 2 == 1, doubled(digit(s, i))).otherwise(digit(s, i))) % 10 == 0)


def kind_spans(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"),
                                                 x["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """(start, kind, end) of the patterns, by start and then kind as listed."""
    def found(mark, pattern, keep, kind):
        got = F.filter(located(text, pattern), keep) if keep else located(text, pattern)
        got = kind_spans(got, kind)
        return F.when(text.contains(mark), got).otherwise(
            F.array().cast("array<struct<start: int, kind: int, end: int>>")) if mark else got

    return F.array_sort(F.concat(
        found("@", EMAIL, None, 0),
        found(".", IP, lambda x: x["txt"].rlike(PARTS), 1),
        found("", CARD, lambda x: luhn(x["txt"]), 2),
        found("+", PHONE, lambda x: F.length(digits_of(x["txt"])).between(9, 15), 3)))


def candidate_spans(text: Column) -> Column:
    """(start, end, code, digits, sep): code has a bit per vote."""
    def vote(c, i):
        return F.when(c, F.lit(1 << i)).otherwise(F.lit(0))

    def describe(x):
        return let(F.struct(
            F.length(digits_of(x["txt"])).alias("n"), F.lower(F.right(x["before"], F.lit(24))).alias("before"),
            F.regexp_replace(x["txt"], "[0-9+]", "").alias("sep")), lambda y: F.struct(
            x["start"].alias("start"), x["end"].alias("end"),
            (vote((x["txt"].startswith("+") & y["n"].between(9, 15))
                  | (y["n"].between(12, 19) & ~x["txt"].rlike(r"[^0-9 -]") & luhn(x["txt"])), 0)
             + vote(x["txt"].rlike(SHAPE), 1) + vote(y["before"].rlike(GAZETTEER), 2)
             + vote(y["before"].rlike(CONTEXT), 3) + vote(F.length(y["sep"]) >= 2, 4)).alias("code"),
            F.when(y["n"] < 10, 0).when(y["n"] < 16, 1).otherwise(2).alias("digits"),
            F.when(F.length(y["sep"]) == 0, 0)
            .when(F.length(F.replace(y["sep"], F.left(y["sep"], F.lit(1)), F.lit(""))) == 0, 1)
            .otherwise(2).alias("sep")))

    return F.transform(located(text, CANDIDATE), describe)


def vote_bits(code: Column) -> list[Column]:
    return [F.shiftright(code, i).bitwiseAND(F.lit(1)).cast("double") for i in range(VOTES)]


def reliabilities(patterns: Column, rounds: int = 20) -> Column:
    """EM for two classes and independent labelers over (v: votes, n: count):
    struct of p (share of class one) and the chance of a vote in class one (a)
    and class two (b)."""
    start = F.struct(F.lit(0.3).alias("p"), F.array(*[F.lit(0.7)] * VOTES).alias("a"),
                     F.array(*[F.lit(0.1)] * VOTES).alias("b"))

    def add(ws, f):
        return F.aggregate(ws, F.lit(0.0), lambda s, w: s + f(w))

    def step(s, _):
        weighed = F.transform(patterns, lambda x: F.struct(
            x["v"].alias("v"), x["n"].alias("n"), (x["n"] * posterior(x["v"], s)).alias("q")))

        def rates(ws, f):
            return F.transform(F.sequence(F.lit(0), F.lit(VOTES - 1)),
                               lambda j: (add(ws, lambda w: f(w) * F.get(w["v"], j)) + 1) / (add(ws, f) + 2))

        return let(weighed, lambda ws: F.struct(
            ((add(ws, lambda w: w["q"]) + 1) / (add(ws, lambda w: w["n"]) + 2)).alias("p"),
            rates(ws, lambda w: w["q"]).alias("a"), rates(ws, lambda w: w["n"] - w["q"]).alias("b")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)


def posterior(votes: Column, s: Column) -> Column:
    """Chance of class one given the votes, under the reliabilities ``s``."""
    logit = F.log(s["p"] / (1 - s["p"]))
    for j in range(VOTES):
        a, b, v = F.get(s["a"], F.lit(j)), F.get(s["b"], F.lit(j)), F.get(votes, F.lit(j))
        logit = logit + F.when(v > 0, F.log(a / b)).otherwise(F.log((1 - a) / (1 - b)))
    return sigmoid(logit)


def feature_ids(c: Column) -> Column:
    on = [F.when(b > 0, F.lit(i)) for i, b in enumerate(vote_bits(c["code"]))]
    return F.array_compact(F.array(*on, c["digits"] + VOTES, c["sep"] + VOTES + DIGITS, F.lit(FEATURES - 1)))


def train_classifier(docs: DataFrame) -> DataFrame:
    """One row: ``w``, the weights of the span classifier (FEATURES doubles)."""
    stats = materialise(
        docs.select(F.explode(candidate_spans(F.coalesce("text", F.lit("")))).alias("c"))
        .groupBy("c.code", "c.digits", "c.sep").agg(F.count("*").cast("double").alias("n")), "pii-votes")
    votes = F.array(*vote_bits(F.col("code")))
    model = (stats.groupBy("code").agg(F.sum("n").alias("n")).groupBy()
             .agg(F.array_sort(F.collect_list(F.struct(votes.alias("v"), F.col("n")))).alias("patterns"))
             .select(reliabilities(F.col("patterns")).alias("s")))
    rows = stats.withColumn("s", model.select("s").scalar()).select(
        F.xxhash64("code", "digits", "sep").alias("row"), posterior(votes, F.col("s")).alias("target"),
        F.col("n").alias("weight"), feature_ids(F.struct("code", "digits", "sep")).alias("ids"))
    feats = rows.select("row", F.explode("ids").alias("feature"), F.lit(1.0).alias("value"))
    w = train(rows.drop("ids"), feats, epochs=150, rate=1.0)
    return materialise(w.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("feature", "w"))).alias("m")).select(
        F.transform(F.sequence(F.lit(0), F.lit(FEATURES - 1)),
                    lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("w")), "pii-weights")


def with_spans(docs: DataFrame, out: str = "_pii") -> DataFrame:
    """``docs`` with column ``out``: base and all spans as (start, kind, end).
    A candidate is added if the classifier is sure of it, its words (gazetteer
    or context) speak for it and it overlaps no base span."""
    weights = train_classifier(docs)
    text = F.coalesce("text", F.lit(""))

    def added(c, w):
        logit = F.aggregate(feature_ids(c), F.lit(0.0), lambda s, f: s + F.get(w, f))
        return (sigmoid(logit) > SURE) & (c["code"].bitwiseAND(F.lit(12)) > 0)

    d = docs.withColumn(out, F.struct(base_spans(text).alias("base"), candidate_spans(text).alias("cand"),
                                      weights.select("w").scalar().alias("w")))
    return d.withColumn(out, let(F.col(out), lambda p: F.struct(p["base"].alias("base"), F.array_sort(F.concat(
        p["base"], kind_spans(F.filter(p["cand"], lambda c: added(c, p["w"]) & ~F.exists(
            p["base"], lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))), 4))).alias("all"))))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts and digest of the pattern spans, all
    spans as text and as an array ``found`` of (start, kind number, end).

    A null text counts as empty. Texts are read whole; a table without digits
    trains no weights and adds no span; repeated rows each give a row; an empty
    table gives none; other columns are not read."""
    d = with_spans(docs.select("doc_id", "text"), "p")
    base = F.col("p.base")

    def count(k):
        return F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return d.select("doc_id", *[count(k) for k in range(4)], F.sha2(span_text(base), 256).alias("base_sha256"),
                    span_text(F.col("p.all")).alias("spans"), F.col("p.all").alias("found"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; spans that
    overlap are replaced together, by the first one's kind. Texts without spans,
    nulls among them, and all other columns stay as they are."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    rows = with_spans(docs.select(F.struct("*").alias("row"), "text"))
    none = F.array().cast("array<struct<start: int, kind: int, end: int>>")

    def merge(done, x):
        last = F.element_at(done, -1)
        return F.when((F.size(done) > 0) & (x["start"] < F.try_element_at(done, F.lit(-1))["end"]),
                      F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
                          last["start"].alias("start"), last["kind"].alias("kind"),
                          F.greatest(last["end"], x["end"]).alias("end"))))
                      ).otherwise(F.concat(done, F.array(x)))

    def cut(spans):
        def piece(x, i):
            at = F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(F.lit(0))
            return F.concat(F.substring("text", at + 1, x["start"] - at), F.get(names, x["kind"]))
        tail = F.substring(F.col("text"), F.element_at(spans, -1)["end"] + 1, F.length("text"))
        return F.concat(F.array_join(F.transform(spans, piece), ""), tail)

    spans = F.col("_pii.all")
    text = F.when(F.size(spans) > 0, let(F.aggregate(spans, none, merge), cut)).otherwise(F.col("text"))
    rows = rows.withColumn("_out", text)
    return rows.select(*[F.col("_out").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
