"""Document fingerprints: invertible Bloom lookup sketches of paragraphs, with DataFrame functions only.

A text is cut into paragraphs (lines, and further at some sentence ends that the sentence itself picks). Each paragraph's
40-bit digest is added to one cell of each of three tables; a cell holds the count, the sum of digests and the sum of a
second hash. Sketches subtract cell by cell, so a paragraph that both versions hold leaves no trace, whatever its place.
Peeling takes a cell whose content is one digest (sums agree with the count), recovers it and takes it out of its other
cells, table after table. If cells are left, the difference was too large for the sketch and is sketched again, larger:
sized by both texts' paragraph counts, then four times that with another hash, and so on until nothing is left.

Everything after the one shuffle of the texts stays in its partition: the rows of a document share its key.

Defined cases: a null text is empty; empty texts have one empty paragraph; the likeness is 1 - differing / all paragraphs,
counted with repetition, so equal texts have 1; repeated rows are documents of their own and stand beside each other in the
order; a null id comes last, in the order of a hash of the text; columns other than the named ones are ignored. Cells are
64-bit sums: a text may repeat one paragraph some eight million times before the sum of its digests is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored

#: Cells in each of a fingerprint's three tables.
CELLS = 8
#: Where a paragraph ends: at a line end, and after a sentence whose last letter is one of a few.
BREAKS = r"\n|(?<=[adeghtu][.!?])\s"
_DIGEST, _CHECK = (1 << 40) - 1, (1 << 30) - 1


def digests(text: Column) -> Column:
    return F.transform(F.split(text, BREAKS), lambda p: F.xxhash64(p).bitwiseAND(F.lit(_DIGEST)))


def _check(x: Column) -> Column:
    return F.xxhash64(F.lit("check"), x).bitwiseAND(F.lit(_CHECK))


def _cell(x: Column, table: Column | int, size: Column, seed: int) -> Column:
    table = F.lit(table) if isinstance(table, int) else table
    return (table * size + F.pmod(F.xxhash64(F.lit(seed), table, x), size)).cast("int")


def _peeled(cells: DataFrame, keys: list[str], seed: int, rounds: int) -> DataFrame:
    """Per key whether cells are left (``failed``) and how many paragraphs were recovered (``d``).

    cells: keys, size (cells in a table), cell, c, k, h. Recovered counts are gathered in cell -1 of their key. Only one
    table's pure cells are peeled at a time, and a digest has one cell in a table, so none is taken out twice.
    """
    group = [*keys, "size", "cell"]
    x, zero = "cast(try_divide(k, c) as bigint)", "cast(0 as bigint)"
    check = f"(xxhash64('check', {x}) & {_CHECK})"
    cell = lambda table: f"cast({table} * size + pmod(xxhash64({seed}, {table}, {x}), size) as int)"  # noqa: E731  as _cell
    row = lambda cell, c, k, h: f"struct({cell} as cell, {c} as c, {k} as k, {h} as h)"
    for r in range(rounds):
        table = r % 3
        pure = f"cell between {table} * size and {table} * size + size - 1 and c != 0 and coalesce(try_mod(k, c), 1) = 0 and {x} >= 0 and h = {check} * c and cell = {cell(table)}"
        others = ", ".join(row(cell(t), "-c", "-k", "-h") for t in range(3) if t != table)
        taken = f"array({others}, {row('-1', 'abs(c)', zero, zero)})"
        rows = f"case when cell >= 0 and c = 0 and k = 0 and h = 0 then array() when {pure} then {taken} else array({row('cell', 'c', 'k', 'h')}) end"
        cells = cells.selectExpr(*keys, "size", f"inline({rows})").groupBy(*group).agg(*(F.sum(v).alias(v) for v in "ckh"))
    cells = cells.filter("cell < 0 or c != 0 or k != 0 or h != 0")
    recovered = F.sum(F.when(F.col("cell") < 0, F.col("c")).otherwise(0))
    return cells.groupBy(*keys).agg(F.max((F.col("cell") >= 0).cast("int")).alias("failed"), recovered.cast("long").alias("d"))


def _tagged(units: Column, name: str) -> Column:
    return F.transform(units, lambda x: F.struct(F.lit(name).alias("side"), x.alias("x")))


def _exploded(df: DataFrame, keep: list[Column | str], sides: dict[str, Column], size: Column, seed: int) -> DataFrame:
    """A row for each paragraph and table: its cell, digest, and the struct of signs of each side it comes from."""
    every = None
    for name, units in sides.items():
        tagged = _tagged(units, name)
        every = tagged if every is None else F.concat(every, tagged)
    rows = df.select(*keep, size.alias("size"), F.explode(every).alias("u")).select("*", F.explode(F.array(*map(F.lit, range(3)))).alias("t"))
    return rows.withColumn("x", F.col("u.x")).withColumn("side", F.col("u.side")).withColumn("cell", _cell(F.col("x"), F.col("t"), F.col("size"), seed)).drop("u", "t")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 4000, most_ranges: int = 200_000) -> DataFrame:
    """(key, doc_id, text, next_text): each row with the next one's text by descending id, the last with the first's.

    Ranges of ids, cut at quantiles, are sorted each by itself; a range also gets a copy of the first row of the range after
    it, which its last row then finds as its next. ``most_ranges`` bounds the table of first rows, which is broadcast.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    count, nulls = ids.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    each = max(bucket_rows, count // most_ranges)
    ranges, null_ranges = max(1, count // each), max(1, nulls // each)
    coarse = min(ranges, 64)
    edges = ids.agg(F.percentile_approx("doc_id", [i / coarse for i in range(coarse + 1)], 10_000).alias("q")).first()["q"] or [0, 0]
    edges = sorted(set(edges), reverse=True)  # at most 65 numbers; each range between two of them is cut evenly
    edges = edges if len(edges) > 1 else [edges[0], edges[0] - 1]
    fine = -(-ranges // coarse)
    top = F.array(*(F.lit(e).cast("long") for e in edges))
    at = F.least(F.greatest(F.size(F.filter(top, lambda e: e >= F.col("doc_id"))), F.lit(1)), F.lit(len(edges) - 1))
    high, low = F.element_at(top, at), F.element_at(top, at + 1)
    inner = F.least(F.greatest(F.floor((high - F.col("doc_id")) / (high - low) * fine), F.lit(0)), F.lit(fine - 1))
    # rows without an id stand in the order of their marks, which are spread evenly
    by_mark = F.least(F.floor((F.lit(2.0**63) - F.col("mark")) / 2.0**64 * null_ranges), F.lit(null_ranges - 1))
    bucket = F.when(F.col("doc_id").isNull(), len(edges) * fine + by_mark).otherwise((at - 1) * fine + inner).cast("int")
    rows = rows.withColumn("mark", F.xxhash64("text")).withColumn("bucket", bucket)
    firsts = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "mark")).alias("first"))  # a row for each range
    ring = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = Window.partitionBy(F.lit(0)).orderBy("bucket")
    firsts = firsts.withColumn("before", F.coalesce(F.lag("bucket").over(step), F.last("bucket").over(ring)))
    firsts = firsts.select(F.col("bucket").alias("own"), "before", F.col("first.doc_id").alias("first_id"), F.col("first.mark").alias("first_mark"))
    copies = rows.join(F.broadcast(firsts), (F.col("bucket") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("mark") == F.col("first_mark")))
    copies = copies.select("doc_id", "text", F.col("before").alias("bucket"), "mark").dropDuplicates(["bucket", "doc_id", "mark"])
    both = rows.withColumn("copy", F.lit(0)).unionByName(copies.withColumn("copy", F.lit(1)))
    parts = max(1, ranges + null_ranges, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = Window.partitionBy("bucket").orderBy("copy", F.desc_nulls_last("doc_id"), F.desc("mark"))
    seen = both.repartition(parts, "bucket").withColumn("next_text", F.lead("text").over(order)).withColumn("place", F.row_number().over(order))
    key = (F.col("bucket").cast("long") * (1 << 40) + F.col("place")).alias("key")
    return seen.filter("copy = 0").select(key, "doc_id", "text", "next_text")


def edited(text: Column, other: Column) -> Column:
    """The text whose last third is replaced by as much of the other's beginning, or all of it."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(other, F.lit(1), third))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS, scale: float = 2.0) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    A second sketch has ``scale`` cells for each paragraph of both texts, a further one four times as many as the one before.
    """
    pairs = with_next(docs, id_col, text_col).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    units = stored(
        pairs.select("key", "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("changed"), digests(F.col("next_text")).alias("next")),
        "paragraphs",
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = units.repartition(parts, "key")
    size = F.lit(cells)

    # the fingerprints: every document's three sketches side by side, a row for each cell
    rows = _exploded(units, ["key"], {"own": F.col("own"), "changed": F.col("changed"), "next": F.col("next")}, size, 0)
    sums = []
    for side in ("own", "changed", "next"):
        mine = F.col("side") == side
        sums += [F.sum(F.when(mine, v).otherwise(0)).cast("long").alias(f"{side}_{n}") for n, v in (("c", F.lit(1)), ("k", F.col("x")), ("h", _check(F.col("x"))))]
    sketch = rows.groupBy("key", "size", "cell").agg(*sums)

    def printed(side: str) -> Column:
        full = F.sort_array(F.collect_list(F.when(F.col(f"{side}_c") != 0, F.struct("cell", *(F.hex(f"{side}_{v}").alias(v) for v in "ckh")))))
        return F.array_join(F.transform(full, lambda x: F.concat_ws(":", x["cell"].cast("string"), x["c"], x["k"], x["h"])), ";")

    prints = sketch.groupBy("key").agg(printed("own").alias("fingerprint"), printed("changed").alias("edited_fingerprint"))

    # the first attempt: the fingerprints subtracted
    row = lambda which, other: F.struct(F.lit(which).alias("which"), *((F.col(f"own_{v}") - F.col(f"{other}_{v}")).alias(v) for v in "ckh"))
    diff = sketch.select("key", "size", "cell", F.explode(F.array(row(0, "changed"), row(1, "next"))).alias("d")).select("key", "d.which", "size", "cell", "d.c", "d.k", "d.h").filter("c != 0 or k != 0 or h != 0")
    state = stored(_peeled(diff, ["key", "which"], 0, 6), "peeled")

    # then larger sketches of what failed, sized by the texts, until none is left
    attempt = 0
    while not (failed := state.filter("failed = 1").select("key", "which")).isEmpty():
        attempt += 1
        again = failed.join(units, "key").withColumn("other", F.when(F.col("which") == 0, F.col("changed")).otherwise(F.col("next")))
        n = F.size("own") + F.size("other")
        larger = F.pow(F.lit(2.0), F.ceil(F.log2(n * F.lit(scale * 4.0 ** (attempt - 1)) / 3.0 + 4))).cast("int")
        rows = _exploded(again, ["key", "which"], {"own": F.col("own"), "other": F.col("other")}, larger, attempt)
        sign = F.when(F.col("side") == "own", 1).otherwise(-1)
        diff = rows.groupBy("key", "which", "size", "cell").agg(F.sum(sign).cast("long").alias("c"), F.sum(sign * F.col("x")).cast("long").alias("k"), F.sum(sign * _check(F.col("x"))).cast("long").alias("h")).filter("c != 0 or k != 0 or h != 0")
        more = _peeled(diff, ["key", "which"], attempt, 9)
        state = stored(state.filter("failed = 0").unionByName(more), "peeled")
    per_key = state.groupBy("key").agg(*(F.max(F.when(F.col("which") == w, F.col("d"))).alias(f"d{w}") for w in (0, 1)))

    like = lambda d, other: F.greatest(F.lit(0.0), 1 - F.coalesce(F.col(d), F.lit(0)) / (F.size("own") + F.size(other)))
    out = units.join(prints, "key").join(per_key, "key", "left")
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", like("d0", "changed").alias("near_edited"), like("d1", "next").alias("near_next"))
