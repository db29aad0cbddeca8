"""Mixing sources to target weights, in blocks of words.

Sources in code point order, null last, weigh 5, 2, 1, repeating, and share ``PERCENT`` of all words; no target exceeds
``MOST`` times its source, and the excess is shared anew by weight. The documents of a source lie on a line that is cut
into blocks of ``BLOCK_WORDS`` words. Output shards of ``SHARD_SLOTS`` slots draw their sources from the multinomial
distribution of the targets; slots drawn beyond a source's target go, by index, to sources that were drawn too rarely.
Slot j of a source is block j modulo its number of blocks, put through a pseudorandom permutation of the block numbers
that source and round key (swap-or-not, which needs no power of two). Slots and blocks are joined by index.

All hashes have fixed seeds: reruns agree. The place of a document in its source is a sum over chunks of about
``CHUNK`` documents, over chunks of chunks and over those, so no source has to fit into a task.

Cases: null, empty and blank texts have no words and nothing is taken of them; very long texts span many blocks;
repeated rows are mixed each; rows tied in id, words and text share adjoining places in either order; a table without
words takes nothing; an empty table gives an empty result. Extra columns pass through ``mixed_documents`` as they are,
unless they begin with ``_mix_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import SPACE, WORD, settle, text_of

WEIGHTS = (5, 2, 1)
PERCENT = 150
MOST = 2
BLOCK_WORDS = 128
SHARD_SLOTS = 4096
CHUNK = 1000
CELLS = 4096
ROUNDS = 24
SEED = 11


def _source_key(column: str) -> Column:
    """Text that sorts by code points with null last, and joins."""
    return F.coalesce(F.concat(F.lit("s"), F.col(column).cast("string")), F.lit("t"))


def _sized(docs: DataFrame, n_docs: int) -> DataFrame:
    text = text_of()
    chunks = max(1, -(-n_docs // CHUNK))
    df = docs.withColumn("_mix_id", F.col("doc_id").cast("long")).withColumn("_mix_src", _source_key("source"))
    df = df.withColumn("_mix_size", F.regexp_count(text, F.lit(WORD)).cast("long")).withColumn("_mix_tie", F.xxhash64(text))
    return df.withColumn("_mix_chunk", F.pmod(F.xxhash64("_mix_id", F.lit(SEED)), F.lit(chunks)))


def _placed(df: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows with the first word's place in their source."""
    order = Window.partitionBy("_mix_src", "_mix_chunk").orderBy("_mix_id", "_mix_size", "_mix_tie").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_mix_in_chunk", F.coalesce(F.sum("_mix_size").over(order), F.lit(0)))
    df = df.join(starts, ["_mix_src", "_mix_chunk"])
    return df.withColumn("_mix_start", F.col("_mix_in_chunk") + F.col("_mix_chunk_start")).drop("_mix_in_chunk", "_mix_chunk_start")


def _chunk_starts(sizes: DataFrame) -> DataFrame:
    chunks = sizes.groupBy("_mix_src", "_mix_chunk").agg(F.sum("_mix_size").alias("n")).withColumn("g", F.floor(F.col("_mix_chunk") / CHUNK))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    groups = chunks.groupBy("_mix_src", "g").agg(F.sum("n").alias("n"))
    groups = groups.select("_mix_src", "g", F.coalesce(F.sum("n").over(before("_mix_src").orderBy("g")), F.lit(0)).alias("g0"))
    chunks = chunks.select("_mix_src", "g", "_mix_chunk", F.coalesce(F.sum("n").over(before("_mix_src", "g").orderBy("_mix_chunk")), F.lit(0)).alias("c0"))
    return chunks.join(groups, ["_mix_src", "g"]).select("_mix_src", "_mix_chunk", (F.col("g0") + F.col("c0")).alias("_mix_chunk_start"))


def targets(sizes: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per source: words, target, blocks and slots. One row per source is all that the windows see."""
    total = sizes.groupBy("_mix_src").agg(F.sum("_mix_size").alias("size"))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    total = total.withColumn("n", F.row_number().over(Window.orderBy("_mix_src")) - 1)
    total = total.withColumn("w", F.get(weights, (F.col("n") % len(WEIGHTS)).cast("int"))).withColumn("cap", MOST * F.col("size").cast("double"))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("w"), "_mix_src").rowsBetween(Window.unboundedPreceding, -1)
    total = total.withColumn("goal", F.sum("size").over(everything) * PERCENT / 100.0)
    left = F.col("goal") - F.coalesce(F.sum("cap").over(order), F.lit(0.0))
    free = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(order), F.lit(0.0))
    total = total.withColumn("rate", left / free)
    # Sources in order of cap to weight are capped until the rate of what is left stays below.
    open_rate = F.when(F.col("rate") < F.col("cap") / F.col("w"), F.col("rate"))
    total = total.withColumn("rate", F.max(open_rate).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("rate") * F.col("w"), F.col("cap")))
    total = total.select("_mix_src", "size", target.alias("target"), F.ceil(F.col("size") / block_words).alias("blocks"))
    slots = F.when(F.col("size") > 0, F.least(F.round(F.col("target") / F.col("size") * F.col("blocks")).cast("long"), MOST * F.col("blocks"))).otherwise(F.lit(0))
    return total.withColumn("slots", slots)


def _permuted(index: Column, n: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n-1, by rounds of swap-or-not."""

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        high = F.greatest(x, partner)
        return F.when(F.xxhash64(key, r, high).bitwiseAND(F.lit(1)) == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, swap)


def drawn_slots(sources: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, _mix_src, j, block): the slots of all output shards; j counts a source's slots from 0."""
    spark = sources.sparkSession
    n = sources.agg(F.sum("slots")).first()[0] or 0
    line = Window.orderBy("_mix_src").rowsBetween(Window.unboundedPreceding, -1)
    low = F.coalesce(F.sum("slots").over(line), F.lit(0))
    shares = sources.filter("slots > 0").select("_mix_src", low.alias("low"), "slots").withColumn("high", F.col("low") + F.col("slots"))
    width = max(1, -(-n // CELLS))
    cells = shares.select("_mix_src", "low", "high", F.explode(F.expr(f"sequence(low div {width}, (high - 1) div {width})")).alias("cell"))
    draw = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(max(1, n)))
    tickets = spark.range(n).select((F.col("id") / shard_slots).cast("long").alias("shard"), draw.alias("u")).withColumn("cell", F.expr(f"u div {width}"))
    hit = tickets.join(cells, "cell").filter("u >= low AND u < high")
    counts = hit.groupBy("shard", "_mix_src").agg(F.count("u").alias("n"))
    before = Window.partitionBy("_mix_src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("j0", F.coalesce(F.sum("n").over(before), F.lit(0))).join(sources.select("_mix_src", "slots", "blocks"), "_mix_src")
    counts = counts.withColumn("good", F.greatest(F.lit(0), F.least(F.col("n"), F.col("slots") - F.col("j0"))))
    good = counts.filter("good > 0").select("shard", "_mix_src", F.explode(F.expr("sequence(j0, j0 + good - 1)")).alias("j"))
    # Tickets beyond a source's slots, numbered, get the slots that were never drawn, numbered alike.
    numbers = lambda key: Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    excess = counts.filter("good < n").select("shard", "_mix_src", (F.col("n") - F.col("good")).alias("e"))
    excess = excess.withColumn("k0", F.coalesce(F.sum("e").over(numbers(["_mix_src", "shard"])), F.lit(0)))
    excess = excess.select("shard", F.explode(F.expr("sequence(k0, k0 + e - 1)")).alias("k"))
    had = hit.groupBy("_mix_src").agg(F.count("u").alias("had"))
    short = sources.filter("slots > 0").join(had, "_mix_src", "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("had < slots").select("_mix_src", "had", (F.col("slots") - F.col("had")).alias("d"))
    short = short.withColumn("k0", F.coalesce(F.sum("d").over(numbers(["_mix_src"])), F.lit(0)))
    short = short.select("_mix_src", "had", F.posexplode(F.expr("sequence(k0, k0 + d - 1)")).alias("t", "k"))
    moved = excess.join(short, "k").select("shard", "_mix_src", (F.col("had") + F.col("t")).alias("j"))
    slots = good.union(moved).join(sources.select("_mix_src", "blocks"), "_mix_src")
    turn = F.expr("j div blocks")
    block = _permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.xxhash64("_mix_src", turn, F.lit(SEED)))
    return slots.select("shard", "_mix_src", "j", block.alias("block"))


def _taken_pieces(placed: DataFrame, sources: DataFrame, block_words: int) -> DataFrame:
    """For each document and block it lies in: its first word there, its words there, and how often the block is taken."""
    times = drawn_slots(sources).groupBy("_mix_src", "block").agg(F.count("j").alias("times"))
    w = block_words
    pieces = placed.filter("_mix_size > 0").select("_mix_src", "_mix_start", "_mix_size", F.explode(F.expr(f"sequence(_mix_start div {w}, (_mix_start + _mix_size - 1) div {w})")).alias("block"))
    first = F.greatest(F.lit(0), F.col("block") * w - F.col("_mix_start"))
    last = F.least(F.col("_mix_size"), (F.col("block") + 1) * w - F.col("_mix_start"))
    pieces = pieces.select("_mix_src", "_mix_start", "block", first.alias("first"), (last - first).alias("words"))
    return pieces.join(times, ["_mix_src", "block"])


def _plan(docs: DataFrame, block_words: int) -> tuple[int, DataFrame, DataFrame, DataFrame]:
    n_docs = docs.count()
    narrow = settle(_sized(docs.select("doc_id", "source", "text"), n_docs).drop("doc_id", "source", "text"), "mix-sizes")
    sources = settle(targets(narrow, block_words), "mix-targets")
    starts = settle(_chunk_starts(narrow), "mix-starts")
    return n_docs, narrow, sources, starts


def mix_sources(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every document."""
    _, narrow, sources, starts = _plan(docs, block_words)
    placed = _placed(narrow, starts)
    taken = _taken_pieces(placed, sources, block_words).groupBy("_mix_src", "_mix_start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    taken = taken.withColumn("_mix_some", F.lit(True))
    rows = placed.withColumn("_mix_some", F.col("_mix_size") > 0).join(taken, ["_mix_src", "_mix_start", "_mix_some"], "left")
    rows = rows.join(sources.select("_mix_src", F.col("size").alias("source_size"), "target"), "_mix_src")
    return rows.select(
        F.col("_mix_id").alias("doc_id"), F.when(F.col("_mix_src") != "t", F.substring("_mix_src", 2, 1 << 30)).alias("source"), F.col("_mix_size").alias("size"),
        "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: a row for each time that a document is taken, with the words of the blocks taken then.

    A document that lies in taken blocks as a whole keeps its text as it is; n_chars follows the text.
    """
    n_docs, narrow, sources, starts = _plan(docs, block_words)
    pieces = _taken_pieces(_placed(narrow, starts), sources, block_words)
    ranges = pieces.groupBy("_mix_src", "_mix_start").agg(F.sort_array(F.collect_list(F.struct("first", "words", "times"))).alias("_mix_ranges"))
    rows = _placed(_sized(docs, n_docs), starts).filter("_mix_size > 0").join(ranges, ["_mix_src", "_mix_start"])
    rows = rows.withColumn("_mix_copy", F.explode(F.expr("sequence(1, cast(array_max(transform(_mix_ranges, r -> r.times)) AS int))")))
    rows = rows.withColumn("_mix_ranges", F.expr("filter(_mix_ranges, r -> r.times >= _mix_copy)"))
    whole = F.expr("aggregate(_mix_ranges, 0L, (n, r) -> n + r.words) = _mix_size")
    tokens = F.when(~whole, F.regexp_extract_all("text", F.lit(f"({SPACE}*{WORD})"), F.lit(1)))
    rows = rows.withColumn("_mix_whole", whole).withColumn("_mix_tokens", tokens)
    part = F.expr("array_join(flatten(transform(_mix_ranges, r -> slice(_mix_tokens, cast(r.first AS int) + 1, cast(r.words AS int)))), '')")
    text = F.when(F.col("_mix_whole"), F.col("text")).otherwise(F.regexp_replace(part, f"^{SPACE}+", ""))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
