"""Operator 4: personal data by weak supervision. DataFrame functions only.

Base rules find e-mail addresses, IP addresses, card and phone numbers by pattern and check. Further candidates (runs of letters and digits such as
keys, tokens and passwords) are judged by labelers that vote yes, no or abstain: a pattern labeler, a gazetteer labeler (names of fields before the
candidate) and context labelers (quotes or an equals sign around it, how letters and digits mix). Expectation-maximisation estimates the labelers'
reliabilities from the counts of vote patterns, over all candidates; with the probabilities that follow, a naive Bayes span classifier is trained on
features of all candidates, and it decides which spans are added as kind `secret`. What reaches the driver are counts of vote patterns and of
feature values, whose number is fixed.

Positions are in code points. The regular expressions are those of the rules in a form that takes linear time on long runs: possessive, and starting
only where a match can start.

Edge cases: null text is empty; candidates that overlap a base span are dropped; without candidates no span is added; repeated rows are judged alike;
very long texts are searched whole; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_VALID = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"  # shorter runs are no cards; each run is one match, so leaving them out moves no other
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CANDIDATE = r"(?<![A-Za-z0-9])[A-Za-z]*+[0-9][A-Za-z0-9]{7,}+"
#: Names of fields whose value is private (the gazetteer).
FIELDS = ("password", "passwd", "pwd", "passphrase", "token", "secret", "apikey", "api_key", "key", "auth", "credential", "pin", "ssn", "iban", "account", "passport", "licence", "license")
GAZETTEER = rf"(?i)(?:{'|'.join(FIELDS)})[\x20:=\"']*$"
SHAPE = r"^(?:[A-Z]{4}[A-Z0-9]{16}|[0-9a-f]{16,}|[0-9]{13,19}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})$"
LABELERS = ("shape", "gazetteer", "quoted", "mixed")
THRESHOLD = 0.5
RUN = 256


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), 0)


PLACE = "struct<start: int, end: int, value: string, before: string, after: string>"


def _places(runs: str) -> Column:
    """Start and end of each match; runs: column of arrays of (before, value, after), in runs of bounded length so that appending stays cheap."""
    empty = F.array().cast(f"array<{PLACE}>")

    def one(s: Column, m: Column) -> Column:
        start = s["at"] + F.length(m["before"])
        end = start + F.length(m["value"])
        place = F.struct(start.alias("start"), end.alias("end"), m["value"].alias("value"), F.right(m["before"], F.lit(40)).alias("before"), F.left(m["after"], F.lit(1)).alias("after"))
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(place)).alias("out"))

    def run(s: Column, r: Column) -> Column:
        inner = F.aggregate(r, F.struct(s["at"].alias("at"), empty.alias("out")), one)
        return F.struct(inner["at"].alias("at"), F.concat(s["out"], inner["out"]).alias("out"))

    return F.aggregate(runs, F.struct(F.lit(0).alias("at"), empty.alias("out")), run, lambda s: s["out"])


def luhn(digits: Column) -> Column:
    values = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), lambda c, i: (c.cast("int") * (1 + i % 2)).alias("v"))
    return F.aggregate(values, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


CHECKS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "email": (EMAIL, lambda v: F.lit(True)),
    "ip": (IP, lambda v: v.rlike(IP_VALID)),
    "card": (CARD, lambda v: F.length(_digits(v)).between(13, 19) & F.when(F.length(_digits(v)).between(13, 19), luhn(_digits(v))).otherwise(False)),
    "phone": (PHONE, lambda v: F.length(_digits(v)).between(9, 15)),
}
#: A character without which a text has no match.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base (array of kind, start, end), candidates (array of start, end, votes and features)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    none = F.array().cast("array<string>")
    every = {kind: pattern for kind, (pattern, _) in CHECKS.items()} | {"candidate": CANDIDATE}
    rows = rows.withColumns({f"_{k}": F.when(F.contains("_text", F.lit(NEEDS[k])), matches(F.col("_text"), p)).otherwise(none) if k in NEEDS else matches(F.col("_text"), p) for k, p in every.items()})
    # step by step, as columns: inside a lambda, an expression would be worked out anew for each element
    names = list(every)
    rows = rows.withColumns({f"_cut_{k}": F.when(F.size(f"_{k}") > 0, F.split("_text", every[k], -1)) for k in names}).drop("_text")
    rows = rows.withColumns({f"_zip_{k}": F.arrays_zip(F.col(f"_cut_{k}").alias("before"), F.col(f"_{k}").alias("value"), F.slice(f"_cut_{k}", 2, F.greatest(F.size(f"_{k}"), F.lit(1))).alias("after")) for k in names})
    parts = lambda k: F.transform(F.sequence(F.lit(0), (F.size(f"_{k}") - 1).cast("int"), F.lit(RUN)), lambda i: F.slice(f"_zip_{k}", i + 1, F.least(F.lit(RUN), F.size(f"_{k}") - i)))
    rows = rows.withColumns({f"_runs_{k}": F.when(F.size(f"_{k}") > 0, parts(k)) for k in names})
    none_placed = F.array().cast(f"array<{PLACE}>")
    rows = rows.withColumns({f"_at_{k}": F.when(F.size(f"_{k}") > 0, _places(f"_runs_{k}")).otherwise(none_placed) for k in names})
    span = lambda k: lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    holds = lambda check: lambda s: check(s["value"])
    valid = [F.transform(F.filter(f"_at_{kind}", holds(check)), span(i)) for i, (kind, (_, check)) in enumerate(CHECKS.items())]
    rows = rows.withColumn("base", F.concat(*valid))
    free = F.filter("_at_candidate", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return rows.select("doc_id", "base", F.transform(free, _judge).alias("candidates"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _judge(c: Column) -> Column:
    """Votes (1 yes, 0 no, -1 abstains) and discrete features of a candidate."""
    value, before, after = c["value"], c["before"], c["after"]
    digits, length = F.length(_digits(value)), F.length(value)
    named = before.rlike(GAZETTEER)
    tied = before.rlike("[=:\"'/]$")
    quoted = before.rlike("[\"']$") & after.isin('"', "'")
    hops = F.size(F.split(value, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"))
    return F.struct(
        c["start"].alias("start"), c["end"].alias("end"),
        _vote(value.rlike(SHAPE), length < 10).alias("shape"),
        _vote(named, before.rlike(r"(?i)(?:page|item|number|no|id|year|chapter)[\x20.:#]*$")).alias("gazetteer"),
        _vote(quoted | tied, before.rlike(r"[,;]\s*$")).alias("quoted"),
        _vote((hops >= 4) | (length >= 16), hops <= 2).alias("mixed"),
        F.least(length.cast("int") / 4, F.lit(10)).cast("int").alias("f_length"),
        (digits * 4 / length).cast("int").alias("f_digits"),
        F.when(value.rlike("[a-z]") & value.rlike("[A-Z]"), 3).when(value.rlike("[a-z]"), 2).when(value.rlike("[A-Z]"), 1).otherwise(0).alias("f_case"),
        F.least(hops, F.lit(8)).cast("int").alias("f_hops"),
        F.when(named, 2).when(tied, 1).otherwise(0).alias("f_before"),
        F.when(after.rlike("[\"']"), 2).when(after.rlike(r"^\s|^$"), 0).otherwise(1).alias("f_after"),
    )


FEATURES = ("f_length", "f_digits", "f_case", "f_hops", "f_before", "f_after")


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """Probability that a candidate is private, by vote pattern; patterns: (votes, count). Each labeler has a rate of yes among its votes on private
    and on other candidates; they start from the share of yes votes. Sums run over at most 3 ** labelers patterns."""
    post = {v: (sum(x == 1 for x in v) + 0.5) / (sum(x >= 0 for x in v) + 1) for v, _ in patterns}
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        prior = (sum(n * post[v] for v, n in patterns) + 1) / (total + 2)
        rates = []
        for j in range(len(LABELERS)):
            voted = [(v, n) for v, n in patterns if v[j] >= 0]
            on_yes = sum(n * post[v] for v, n in voted)
            on_no = sum(n * (1 - post[v]) for v, n in voted)
            # one vote each way that the labeler is right
            rates.append(((sum(n * post[v] for v, n in voted if v[j] == 1) + 1) / (on_yes + 1.5), (sum(n * (1 - post[v]) for v, n in voted if v[j] == 1) + 0.5) / (on_no + 1.5)))
        new = {}
        for v, _ in patterns:
            z = math.log(prior / (1 - prior))
            for vote, (yes, no) in zip(v, rates, strict=True):
                if vote == 1:
                    z += math.log(yes / no)
                elif vote == 0:
                    z += math.log(max(1e-9, 1 - yes) / max(1e-9, 1 - no))
            new[v] = 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))
        post = new
    return post


def train(found: DataFrame) -> tuple[float, dict[tuple[str, int], float]]:
    """Log-odds of the classifier: the prior's, and those of each feature value. found: what `find` gives."""
    each = found.select(F.inline("candidates"))
    # both tables have a fixed number of rows at most, whatever the input
    patterns = [(tuple(r[x] for x in LABELERS), r["count"]) for r in each.groupBy(*LABELERS).count().orderBy(*LABELERS).collect()]
    if not patterns:
        return -40.0, {}
    post = expectation_maximisation(patterns)
    key = F.concat_ws(",", *LABELERS)
    private = F.create_map(*[F.lit(x) for v, p in post.items() for x in (",".join(map(str, v)), p)])[key]
    long = each.select(private.alias("p"), F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES])).alias("x")).select("p", "x.*")
    sums = long.groupBy("feature", "value").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).orderBy("feature", "value").collect()
    yes = sum(r["yes"] for r in sums if r["feature"] == FEATURES[0])
    no = sum(r["no"] for r in sums if r["feature"] == FEATURES[0])
    weights = {(r["feature"], r["value"]): math.log((r["yes"] + 0.5) / (yes + 1)) - math.log((r["no"] + 0.5) / (no + 1)) for r in sums}
    return math.log((yes + 0.5) / (no + 0.5)), weights


def find_pii(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and spans: array<struct<kind: string, start: int, end: int>>, by kind as listed in KINDS, then start."""
    found = materialise(find(docs), "pii")
    prior, weights = train(found)
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.col("base")
    if weights:
        table = F.create_map(*[F.lit(x) for (f, v), w in weights.items() for x in (f"{f}{v}", float(w))])
        logit = lambda c: sum((F.coalesce(table[F.concat(F.lit(f), c[f].cast("string"))], F.lit(0.0)) for f in FEATURES), F.lit(float(prior)))
        added = F.filter("candidates", lambda c: logit(c) >= math.log(threshold / (1 - threshold)))
        spans = F.concat(spans, F.transform(added, lambda c: F.struct(F.lit(4).alias("kind"), c["start"].alias("start"), c["end"].alias("end"))))
    return found.select("doc_id", F.transform(F.array_sort(spans), lambda s: F.struct(F.element_at(names, s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans."""
    found = find_pii(docs)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"] != "secret")
    return found.select("doc_id", *(count(k) for k in KINDS[:4]), F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
