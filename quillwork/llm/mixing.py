"""Operator 2: mixing sources to target weights by pivotal dependent rounding. DataFrame functions only.

Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share all words; a source's target stops at `most` times its size and the
excess is reshared by weight. A document of a source with target t and size s is due t / s copies. The whole copies are taken; the fractional
parts are rounded dependently: two documents meet, mass moves between them at random, in words, until one of the two has 0 or 1 extra copies,
and the other goes on with what is left. Words are kept exactly at each step, so a source misses its target by less than its last document.

Blocks of `block` documents are rounded by one fold over an array, each leaves one undecided document, and those form the next level of the tree,
`block` times smaller, until each source has one left, which is rounded at random. Blocks are cut by position in a hash order, so a source with a
third of all rows gives many blocks of the same size, and reruns agree.

Edge cases: null and empty texts have size 0 and take 0; a null source is a source of its own; repeated rows are mixed one by one; an empty table
gives no rows; other columns are carried by `mix_sources`, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, materialise, ordered_positions

#: The weights that sources take in turn.
CYCLE = (5, 2, 1)
UNIT = "struct<row: bigint, size: bigint, part: double>"


def word_count(text: Column) -> Column:
    """Number of runs of non-white space. The text is split at white space, which leaves an empty piece where it begins or ends with some."""
    pieces = F.split(text, r"[\x20\x09-\x0D]+")
    blank = F.when(F.element_at(pieces, 1) == "", 1).otherwise(0) + F.when((F.size(pieces) > 1) & (F.element_at(pieces, -1) == ""), 1).otherwise(0)
    return F.coalesce((F.size(pieces) - blank).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, most: int = 3, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """sizes: source, source_size. Adds weight and target (double). Each round caps the sources above their limit and reshares the rest; a round is
    one aggregate whose few numbers reach the driver, and the number of rounds is at most that of distinct limits."""
    ranked = ordered_positions(sizes, F.col("source").asc_nulls_last(), name="sources")
    weights = F.array(*[F.lit(w) for w in cycle])
    table = materialise(ranked.withColumn("weight", F.element_at(weights, (F.col("position") % len(cycle) + 1).cast("int"))), "weights")
    limit = F.col("source_size") * most
    total = table.agg(F.sum("source_size")).first()[0] or 0
    share = None
    while True:
        over = F.lit(False) if share is None else limit < F.col("weight") * F.lit(share)
        capped, weight = table.agg(F.sum(F.when(over, limit).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        new = (total - (capped or 0)) / weight if weight else 0.0
        if share is not None and new <= share:
            break
        share = new
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(float(share)))
    return table.select("source", "source_size", "weight", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target).alias("target"))


def _random(*keys: Column) -> Column:
    """Uniform in [0, 1), fixed by the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) * F.lit(2.0**-53)


def _duel(state: Column, unit: Column, seed: int) -> Column:
    """The carried document meets the next one; the loser of the game is decided, the other is carried."""
    a, b = state["carried"], unit
    up = F.least((1 - a["part"]) * a["size"], b["part"] * b["size"])  # words that may go from b to a
    down = F.least(a["part"] * a["size"], (1 - b["part"]) * b["size"])  # words that may go from a to b
    rises = _random(a["row"], b["row"], F.lit(seed)) * (up + down) < down
    moved = F.when(rises, up).otherwise(-down)
    pa, pb = a["part"] + moved / a["size"], b["part"] - moved / b["size"]
    # exactly which of the two became integral, without trusting rounding errors
    first = F.when(rises, (1 - a["part"]) * a["size"] <= b["part"] * b["size"]).otherwise(a["part"] * a["size"] <= (1 - b["part"]) * b["size"])
    done_a = F.struct(a["row"].alias("row"), F.when(rises, 1).otherwise(0).alias("extra"))
    done_b = F.struct(b["row"].alias("row"), F.when(rises, 0).otherwise(1).alias("extra"))
    keep = lambda x, p: F.struct(x["row"].alias("row"), x["size"].alias("size"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("part"))
    return F.struct(F.when(first, keep(b, pb)).otherwise(keep(a, pa)).alias("carried"), F.concat(state["decided"], F.array(F.when(first, done_a).otherwise(done_b))).alias("decided"))


def round_parts(units: DataFrame, block: int = 128, seed: int = 1) -> DataFrame:
    """units: group, place (long, dense from 0 in each group), row, size (over 0), part (in (0, 1)). Returns row and extra (0 or 1)."""
    decided, level = [], units
    while True:
        level = level.withColumn("_block", F.expr(f"place div {block}"))
        queue = F.sort_array(F.collect_list(F.struct("place", F.struct("row", "size", "part").alias("unit"))))  # at most `block` items
        folded = level.groupBy("group", "_block").agg(queue.alias("queue")).withColumn("units", F.transform("queue", lambda x: x["unit"])).withColumn(
            "state",
            F.aggregate(
                F.slice("units", F.lit(2), F.greatest(F.size("units") - 1, F.lit(0))),
                F.struct(F.element_at("units", 1).cast(UNIT).alias("carried"), F.array().cast("array<struct<row: bigint, extra: int>>").alias("decided")),
                lambda s, x: _duel(s, x, seed),
            ),
        )
        folded = materialise(folded.select("group", F.col("_block").alias("place"), "state.carried", "state.decided"), "rounding")
        decided.append(folded.select(F.inline("decided")))
        left = folded.select("group", "place", "carried.row", "carried.size", "carried.part")
        if not left.where("place > 0").limit(1).count():
            last = left.select("row", F.when(_random(F.col("row"), F.lit(-seed)) < F.col("part"), 1).otherwise(0).alias("extra"))
            out = last
            for part in decided:
                out = out.unionByName(part)
            return out
        level = left


def copies_of(docs: DataFrame, most: int = 3, cycle: tuple[int, ...] = CYCLE, block: int = 128, seed: int = 1) -> DataFrame:
    """docs: row (unique long), doc_id, source, size. Adds source_size, target and copies (0 to `most`)."""
    groups = source_targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), most, cycle)
    # sources are few against rows, but their number has no bound: the planner broadcasts them only under its own size threshold
    due = docs.join(groups, docs["source"].eqNullSafe(groups["source"]), "left").drop(groups["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(rate), F.lit(most))
    due = due.withColumns({"_whole": whole.cast("int"), "_part": F.when((F.col("size") > 0) & (whole < most), rate - whole).otherwise(0.0)})
    open_ = due.where("_part > 0").select(F.col("source").alias("group"), "row", "size", F.col("_part").alias("part"), F.xxhash64("doc_id", F.lit(seed)).alias("_draw"), "doc_id")
    placed = ordered_positions(open_, F.col("group").asc_nulls_first(), "_draw", "doc_id", "row", name="order")
    first = placed.groupBy("group").agg(F.min("position").alias("_first"))
    units = placed.join(first, placed["group"].eqNullSafe(first["group"])).drop(first["group"]).withColumn("place", F.col("position") - F.col("_first"))
    extra = round_parts(units.select("group", "place", "row", "size", "part"), block, seed)
    return due.join(extra, "row", "left").withColumn("copies", F.col("_whole") + F.coalesce("extra", F.lit(0))).drop("_whole", "_part", "extra")


def document_sizes(docs: DataFrame) -> DataFrame:
    """row, doc_id, source, size, print of each row of documents, written once; print is a hash of the text. Rows are numbered in the order of those,
    so that the numbers and what is drawn by them don't depend on how the input is laid out; rows that agree in all are interchangeable."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("print"))
    return ordered_positions(sized, F.col("doc_id").asc_nulls_first(), F.col("source").asc_nulls_first(), "size", "print", name="sizes", position="row")


def mix_report(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, size, source_size, target (of the source, in words), taken (words that the mix takes of this row, repeats counted), copies."""
    mixed = copies_of(document_sizes(docs), **settings)
    return mixed.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), F.col("copies").cast("int").alias("copies"))


def mix_sources(docs: DataFrame, **settings) -> DataFrame:
    """docs with each row as often as the mix takes it. Rows find their copies by doc_id, source, size and text; only rows that agree in all share a
    window, so null ids are no hot group."""
    names = docs.columns
    size, print_, nth, copy = (free_name(names, n) for n in ("_size", "_print", "_nth", "_copy"))
    keys = {"doc_id": "doc_id", "source": "source", "size": size, "print": print_}
    copies = copies_of(document_sizes(docs), **settings).where("copies > 0")
    mine = {c: free_name(names, f"_{c}_of_row") for c in (*keys, "copies", "nth")}
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("row"))
    wanted = copies.select(*(F.col(c).alias(mine[c]) for c in (*keys, "copies")), place.alias(mine["nth"]))
    sized = docs.withColumns({size: word_count(F.col("text")), print_: F.xxhash64("text")})
    numbered = sized.withColumn(nth, F.row_number().over(Window.partitionBy(*keys.values()).orderBy("text")))
    on = F.col(nth) == F.col(mine["nth"])
    for theirs, ours in keys.items():
        on &= F.col(ours).eqNullSafe(F.col(mine[theirs]))
    return numbered.join(wanted, on).withColumn(copy, F.explode(F.sequence(F.lit(1), mine["copies"]))).select(*names)
