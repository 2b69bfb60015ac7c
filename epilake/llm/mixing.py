"""Mixing sources to target weights.

Each source's documents are laid end to end as one stream of tokens (here
words) and cut into blocks of fixed length. The output is a sequence of
slots, cut into shards. Which slots belong to a source is drawn at random:
a pseudorandom permutation deals the sources' draws over all slots, so a
shard's counts by source are a multinomial draw conditioned on the sources'
totals, and the totals are met to the word. A source's j-th draw takes the
block at position j of a pseudorandom permutation of the source's blocks, a
new one for each pass, and slots meet blocks in a join by block index.

``blocks`` packs the drawn text, ``write_shards`` writes it shard by shard in
slot order; ``words_taken`` reports by document and ``mixed_documents`` gives
the mix as documents.

DataFrame operations only, with every random value a hash of the seed, so
reruns agree. A hot source's documents are numbered in three levels of
partial sums, never in one window, and its draws are made in bounded
pieces. What grows with the input is shuffled by (source, block).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, mark, materialise, named, quoted

#: Weights of the sources by code point, repeating (fixed by the contract).
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 512
SLOTS_PER_SHARD = 1024
SEED = 17

#: Rows numbered by one window (few, so that a hot source's windows spread
#: evenly over the tasks), windows numbered by one of the level above, and
#: draws made by one generating row.
BUCKET = 64
LEVEL = 4096
DRAWS = 4096
#: Odd multipliers under 2^21: a block index up to 2^41 stays within a long.
ROUNDS = 4


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    Targets share the total by weight; none is above ``max_repeat`` times its
    source's size, the excess goes to the others by weight. That is the
    level L with sum(min(L * weight, cap)) = total: sources with the
    smallest cap per weight are capped first, and L is the largest of the
    levels that leave the next source uncapped. The windows run over one
    row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("_k", F.row_number().over(rank) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                               (F.col("_k") % len(weights) + 1).cast("int")))
    ratio = Window.orderBy("_ratio", "_k")
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    per = (per.withColumn("_cap", (F.col("source_size") * max_repeat).cast("double"))
           .withColumn("_ratio", F.col("_cap") / F.col("weight"))
           .withColumn("_total", F.sum("source_size").over(whole).cast("double"))
           .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                       / F.sum("weight").over(onward))
           .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level")))
                       .over(whole)))
    return per.select(
        "source", "source_size", "weight",
        F.least(F.coalesce(F.col("_level") * F.col("weight"), F.col("_cap")), F.col("_cap")).alias("target"))


def _key(*parts: Column, digits: int = 8) -> Column:
    """A long of 4 bits a digit from the md5 of the parts (DuckDB has it too)."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("~null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def permuted(df: DataFrame, out: str, x: Column, n: Column, *key: Column) -> DataFrame:
    """``df`` with ``out``: ``x`` (of 0 .. n-1) under a pseudorandom
    permutation of that range, keyed by ``key``.

    Each round rotates the range and then scrambles its lower power of two
    with an odd multiplier and a shifted xor; both are one to one, so no
    value has to be drawn again. One column a step, as each is used twice.
    """
    df = df.withColumns({"_x": x, "_n": F.greatest(n, F.lit(1).cast("long"))})
    df = df.withColumn("_bits", F.floor(F.log2(F.col("_n").cast("double") + 0.5)).cast("int"))
    df = df.withColumns({
        "_size": F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")),
        "_half": F.greatest(F.floor((F.col("_bits") + 1) / 2).cast("int"), F.lit(1))})
    for r in range(ROUNDS):
        df = df.withColumn("_k", _key(*key, F.lit(r)))
        df = df.withColumn("_x", (F.col("_x") + F.col("_k")) % F.col("_n"))
        df = df.withColumn("_low", (F.col("_x") * (F.shiftleft(F.col("_k") % (1 << 20), 1) + 1)
                                    + F.shiftright("_k", 3)) % F.col("_size"))
        df = df.withColumn("_x", F.when(F.col("_x") < F.col("_size"), F.col("_low").bitwiseXOR(
            F.call_function("shiftright", F.col("_low"), F.col("_half")))).otherwise(F.col("_x")))
    return df.withColumn(out, F.col("_x")).drop("_x", "_n", "_bits", "_size", "_half", "_k", "_low")


def starts(sizes: DataFrame, by: Column | None = None) -> DataFrame:
    """``sizes`` (doc_id, source, size) with ``start``: words of the source
    before the document, by a fixed pseudorandom order of the documents
    (a hash of ``by``, the id by default)."""
    spread = sizes.withColumn("_h", _key(F.col("doc_id") if by is None else by, F.lit(SEED), digits=10))
    rows = sizes.count()
    # as many buckets as hold BUCKET rows each, by ranges of the hash
    n = max(1, -(-rows // BUCKET))
    spread = spread.withColumn("_b", F.floor(F.col("_h") * F.lit(n / float(1 << 40))).cast("long"))
    spread = spread.withColumn("_b2", F.floor(F.col("_b") / LEVEL).cast("long"))
    src = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~"))  # null is a source too
    spread = spread.withColumn("_s", src)

    def before(*part):
        return lambda *order: Window.partitionBy(*part).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, -1)

    low = spread.groupBy("_s", "_b2", "_b").agg(F.sum("size").alias("_n"))
    top = (low.groupBy("_s", "_b2").agg(F.sum("_n").alias("_n"))
           .select("_s", "_b2", F.coalesce(F.sum("_n").over(before("_s")("_b2")), F.lit(0)).alias("_o2")))
    low = (low.join(top, ["_s", "_b2"])
           .select("_s", "_b", (F.col("_o2") + F.coalesce(
               F.sum("_n").over(before("_s", "_b2")("_b")), F.lit(0))).alias("_o")))
    return (spread.join(low, ["_s", "_b"])
            .withColumn("start", F.col("_o") + F.coalesce(
                F.sum("size").over(before("_s", "_b")("_h", "doc_id", "size")), F.lit(0)))
            .select("doc_id", "source", "size", "start"))


def slots(targets: DataFrame, block: int = BLOCK_WORDS, per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """The output's slots: slot, shard, source, pass, block, words.

    A source takes whole passes over its blocks and then, in the last pass,
    as many as its target asks for: full blocks in permuted order, the short
    last block of the source always at the end of a pass, and a part of one
    block to finish on the word.
    """
    whole = Window.partitionBy()
    t = (targets.withColumn("_t", F.round("target").cast("long"))
         .filter((F.col("_t") > 0) & (F.col("source_size") > 0))
         .withColumn("_full", F.floor(F.col("source_size") / block).cast("long"))
         .withColumn("_n", F.ceil(F.col("source_size") / block).cast("long"))
         .withColumn("_passes", F.floor(F.col("_t") / F.col("source_size")).cast("long"))
         .withColumn("_rest", F.col("_t") - F.col("_passes") * F.col("source_size"))
         .withColumn("_draws", F.col("_passes") * F.col("_n") + F.ceil(F.col("_rest") / block).cast("long"))
         .withColumn("_from", F.sum("_draws").over(
             Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)))
         .withColumn("_slots", F.sum("_draws").over(whole)))
    # bounded pieces first, spread over the tasks, then the draws of each
    pieces = t.withColumn("_p", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("_draws") - 1) / DRAWS).cast("long")))).repartition("source", "_p")
    draws = pieces.withColumn("_j", F.explode(F.sequence(
        F.col("_p") * DRAWS, F.least(F.col("_draws"), (F.col("_p") + 1) * DRAWS) - 1)))
    draws = draws.select("source", "_full", "_passes", "_rest", "_slots", "_j",
                         F.floor(F.col("_j") / F.col("_n")).cast("long").alias("pass"),
                         (F.col("_j") % F.col("_n")).alias("_at"),
                         (F.coalesce("_from", F.lit(0)) + F.col("_j")).alias("_place"))
    draws = permuted(draws, "_mixed", F.col("_at"), F.col("_full"), F.lit(SEED), F.col("source"), F.col("pass"))
    draws = permuted(draws, "slot", F.col("_place"), F.col("_slots"), F.lit(SEED), F.lit("slots"))
    draws = draws.withColumns({
        "block": F.when(F.col("_at") < F.col("_full"), F.col("_mixed")).otherwise(F.col("_at")),
        "words": F.when(F.col("pass") < F.col("_passes"), F.lit(block).cast("long"))
        .otherwise(F.least(F.lit(block).cast("long"), F.col("_rest") - F.col("_at") * block))})
    return draws.select("slot", F.floor(F.col("slot") / per_shard).cast("long").alias("shard"),
                        "source", "pass", "block", "words")


def shard_counts(out_slots: DataFrame) -> DataFrame:
    """The draw by output shard: shard, source, n (blocks)."""
    return out_slots.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("n"))


def drawn(targets: DataFrame, block: int = BLOCK_WORDS, per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """The slots as a written table, one narrow row per block."""
    return materialise(slots(targets, block, per_shard), "slots")


def mix(placed: DataFrame, out_slots: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """What fills the slots, in pieces of documents: slot, shard, source,
    pass, block, doc_id, size, start (of the document in its source), first
    (word of the document, from 0) and n (words).

    ``placed`` is the result of :func:`starts`, ``out_slots`` of
    :func:`slots` for the same documents and block. Documents without words fill
    no slot.
    """
    pieces = (placed.filter("size > 0")
              .withColumn("block", F.explode(F.sequence(
                  F.floor(F.col("start") / block).cast("long"),
                  F.floor((F.col("start") + F.col("size") - 1) / block).cast("long"))))
              .withColumn("_lo", F.greatest(F.col("start"), F.col("block") * block))
              .withColumn("_hi", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)))
    s = out_slots.withColumnsRenamed({"source": "_source", "block": "_block"})
    return (pieces.join(s, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
            .withColumn("n", F.least(F.col("_hi"), F.col("block") * block + F.col("words")) - F.col("_lo"))
            .filter("n > 0")
            .select("slot", "shard", "source", "pass", "block", "doc_id", "size", "start",
                    (F.col("_lo") - F.col("start")).alias("first"), "n"))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source and size (words) of each row."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       n_words(F.col(text_col)).alias("size"))


def words_taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                block: int = BLOCK_WORDS) -> DataFrame:
    """A row per row of ``docs``: doc_id, size, source_size, target, taken, and
    where the draw put its words: first_slot (null if none are taken) and
    n_slots.

    Null text has no words; null is a source of its own, the last; rows with
    equal ids are mixed as documents of their own. An empty input gives no
    rows.
    """
    placed = materialise(starts(materialise(sized(docs, id_col, text_col, source_col), "sizes")), "starts")
    targets = materialise(source_targets(placed), "targets")
    taken = (mix(placed, drawn(targets, block), block)
             .groupBy("doc_id", "source", "start", "size")
             .agg(F.sum("n").alias("taken"), F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("n_slots")))
    with_words = placed.filter("size > 0").join(
        taken.withColumnsRenamed({"doc_id": "_d", "source": "_s", "start": "_st", "size": "_z"}),
        F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s"))
        & (F.col("start") == F.col("_st")) & (F.col("size") == F.col("_z")), "left")
    without = placed.filter("size = 0").withColumns(
        {c: F.lit(None).cast("long") for c in ("taken", "first_slot", "n_slots")})
    names = ["doc_id", "source", "size", "taken", "first_slot", "n_slots"]
    rows = with_words.select(names).unionByName(without.select(names)).fillna(0, ["taken", "n_slots"])
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    return rows.join(t, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots")


def _mixed_by_text(docs: DataFrame, block: int, per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """What the slots take (the columns of :func:`mix`) of each id and text:
    ``doc_id`` is a struct of the id and ``_th``, the text's hash. Documents lie
    as in :func:`words_taken`; those without an id are spread by their texts."""
    by = F.coalesce(F.col("doc_id.doc_id").cast("string"), F.concat(F.lit("~"), F.col("doc_id._th").cast("string")))
    placed = materialise(starts(materialise(docs.select(
        F.struct(F.col("doc_id"), F.xxhash64("text").alias("_th")).alias("doc_id"),
        F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size")), "sizes"), by), "starts")
    targets = materialise(source_targets(placed), "targets")
    return mix(placed, drawn(targets, block, per_shard), block)


def _join_texts(docs: DataFrame, takes: DataFrame, a: str, b: str, id_: str, hash_: str) -> DataFrame:
    """``takes`` (``id_``, ``hash_`` and more) with the row of ``docs`` of that id
    and text; ``a`` and ``b`` are names for its own marks. One row of text
    stands for its repeats, which are in takes; the join meets the texts where
    the aggregate has dealt them by the same columns."""
    uniq = docs.withColumns({a: mark(F.col("doc_id")), b: F.xxhash64("text")}).dropDuplicates([a, b])
    return uniq.join(takes.hint("merge"), (F.col(a) == F.col(id_)) & (F.col(b) == F.col(hash_)))


def _with_words(text: str, of: Callable[[Column], Column]) -> Column:
    """``of`` the words of ``text``, as a bound variable: within a lambda an
    expression would cut the text anew for each element."""
    return F.transform(F.array(F.regexp_extract_all(text, F.lit(f"({WORD})"))), of)[0]


def _cut(words: Column, span: Column) -> Column:
    return F.slice(words, span["first"].cast("int") + 1, span["n"].cast("int"))


def blocks(docs: DataFrame, block: int = BLOCK_WORDS, per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """The packed output, a row per slot: shard, slot, source, pass, block, n
    (words), doc_ids (of its pieces, in order) and text (the words, joined by
    spaces).

    Every block has ``block`` words but for a source's last one and the one
    that finishes its target. Documents without words are in none; null is a
    source of its own; repeated rows are documents of their own; other columns
    aren't read, and an empty table gives no rows. A very long document is cut
    into words once for each pass that takes it; a slot's pieces are at most
    ``block``.
    """
    takes = (_mixed_by_text(docs, block, per_shard).groupBy("doc_id", "source", "start", "pass")
             .agg(F.collect_list(F.struct("slot", "shard", "block", "first", "n")).alias("spans"))
             .select(mark(F.col("doc_id.doc_id")).alias("_id"), F.col("doc_id._th").alias("_hash"),
                     F.col("source").alias("_source"), "start", "pass", "spans"))
    joined = _join_texts(docs.select("doc_id", "text"), takes, "_of", "_th", "_id", "_hash")
    pieces = joined.select("doc_id", "_source", "start", "pass", F.explode(_with_words(
        "text", lambda w: F.transform("spans", lambda s: F.struct(
            s["slot"].alias("slot"), s["shard"].alias("shard"), s["block"].alias("block"),
            s["first"].alias("first"), s["n"].alias("n"), F.array_join(_cut(w, s), " ").alias("text"))))).alias("p"))
    packed = pieces.groupBy("p.shard", "p.slot", F.col("_source").alias("source"), "pass", "p.block").agg(
        F.sum("p.n").alias("n"), F.sort_array(F.collect_list(F.struct(
            (F.col("start") + F.col("p.first")).alias("at"), "doc_id", "p.text"))).alias("parts"))
    return packed.select("shard", "slot", "source", "pass", "block", "n", F.col("parts.doc_id").alias("doc_ids"),
                         F.array_join("parts.text", " ").alias("text"))


def write_shards(docs: DataFrame, path: str, block: int = BLOCK_WORDS, per_shard: int = SLOTS_PER_SHARD) -> None:
    """Write :func:`blocks` as Parquet: a shard is whole within one file, in
    slot order."""
    (blocks(docs, block, per_shard).repartition("shard").sortWithinPartitions("shard", "slot")
     .write.parquet(path))


def mixed_documents(docs: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: a row for each pass that takes words of a
    document, with the columns of ``docs``.

    A pass that takes the whole document repeats its text as it is; one that
    takes part of it gives the taken words, in order, joined by spaces
    (``n_chars``, if there, follows). Documents without words have nothing
    to take and are left out. Other columns pass through as they are,
    whatever their names; an empty table gives no rows.
    """
    cols = docs.columns
    a, b, id_, hash_, whole, spans = named(cols, "_id", "_hash", "_of", "_th", "_whole", "_spans")
    takes = (_mixed_by_text(docs, block).groupBy("doc_id", "source", "start", "size", "pass")
             .agg(F.sum("n").alias("taken"), F.sort_array(F.collect_list(F.struct("first", "n"))).alias("spans"))
             .select(mark(F.col("doc_id.doc_id")).alias(id_), F.col("doc_id._th").alias(hash_),
                     (F.col("taken") == F.col("size")).alias(whole),
                     F.when(F.col("taken") != F.col("size"), F.col("spans")).alias(spans)))
    joined = _join_texts(docs, takes, a, b, id_, hash_)
    part = _with_words("text", lambda w: F.array_join(F.flatten(F.transform(spans, lambda s: _cut(w, s))), " "))
    out = joined.withColumn("text", F.when(F.col(whole), F.col("text")).otherwise(part))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.when(F.col(whole), F.col("n_chars"))
                             .otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*quoted(cols))


def oracle_sql(weights=WEIGHTS, max_repeat: int = MAX_REPEAT, block: int = BLOCK_WORDS, seed: int = SEED) -> str:
    """The same result in DuckDB, with plain windows for the numbering."""
    def key(*parts: str, digits: int = 8) -> str:
        text = " || ':' || ".join(f"coalesce(CAST({p} AS VARCHAR), '~null')" for p in parts)
        return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"

    def permuted_sql(level: str, to: str, value: str, n: str, *parts: str) -> tuple[str, str]:
        """Steps that add ``value`` permuted within ``n`` as v, and the last one's name."""
        steps = [f"{to}0 AS (SELECT *, CAST(floor(log2(m + 0.5)) AS INTEGER) AS bits FROM "
                 f"(SELECT *, greatest({n}, 1) AS m, {value} AS v FROM {level}))"]
        at = f"{to}0"
        for r in range(ROUNDS):
            k = key(str(seed), *parts, str(r))
            steps += [
                f"{to}k{r} AS (SELECT * EXCLUDE (v), (v + {k}) % m AS v, {k} AS k FROM {at})",
                f"{to}l{r} AS (SELECT *, (v * (((k % 1048576) << 1) + 1) + (k >> 3)) % (1::BIGINT << bits) AS w "
                f"FROM {to}k{r})",
                f"{to}m{r} AS (SELECT * EXCLUDE (v, w, k), CASE WHEN v < (1::BIGINT << bits) THEN xor(w, w >> "
                f"greatest((bits + 1) // 2, 1)) ELSE v END AS v FROM {to}l{r})"]
            at = f"{to}m{r}"
        return ",\n".join(steps), at

    by_block, blocks_at = permuted_sql("drawn", "in_pass_", "pos", "full_n", "source", "pass")
    by_slot, slots_at = permuted_sql("placed", "in_mix_", "place", "n_slots", "'slots'")
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         {key('doc_id', str(seed), digits=10)} AS h
  FROM documents),
p AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM d),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM s0),
s2 AS (SELECT *, [{', '.join(f'CAST({w} AS DOUBLE)' for w in weights)}][k % {len(weights)} + 1] AS weight,
         CAST(source_size * {max_repeat} AS DOUBLE) AS cap FROM s1),
s3 AS (SELECT *, cap / weight AS ratio FROM s2),
s4 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, k
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY ratio, k
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM s3),
s5 AS (SELECT *, max(CASE WHEN lv <= ratio THEN lv END) OVER () AS l FROM s4),
t AS (SELECT source, source_size, least(coalesce(l * weight, cap), cap) AS target FROM s5),
u AS (SELECT *, CAST(round(target) AS BIGINT) AS tt, source_size // {block} AS full_n,
        (source_size + {block} - 1) // {block} AS n FROM t WHERE round(target) > 0 AND source_size > 0),
w AS (SELECT *, tt // source_size AS passes, tt % source_size AS rest FROM u),
y AS (SELECT *, passes * n + (rest + {block} - 1) // {block} AS n_draws FROM w),
z AS (SELECT *, CAST(sum(n_draws) OVER () AS BIGINT) AS n_slots,
        CAST(coalesce(sum(n_draws) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING
          AND 1 PRECEDING), 0) AS BIGINT) AS before FROM y),
drawn AS (SELECT *, j % n AS pos, j // n AS pass
          FROM (SELECT *, unnest(generate_series(0, n_draws - 1)) AS j FROM z)),
{by_block},
placed AS (SELECT source, n_slots, before + j AS place, CASE WHEN pos < full_n THEN v ELSE pos END AS block,
             CASE WHEN pass < passes THEN {block} ELSE least({block}, rest - pos * {block}) END AS words
           FROM {blocks_at}),
{by_slot},
slots AS (SELECT source, block, words, v AS slot FROM {slots_at}),
pieces AS (SELECT doc_id, source, start, size, unnest(generate_series(start // {block}, (start + size - 1) // {block})) AS block
           FROM p WHERE size > 0),
met AS (SELECT a.doc_id, a.source, a.start, a.size, b.slot, least(a.start + a.size, (a.block + 1) * {block},
          a.block * {block} + b.words) - greatest(a.start, a.block * {block}) AS n
        FROM pieces a JOIN slots b ON a.source IS NOT DISTINCT FROM b.source AND a.block = b.block),
got AS (SELECT doc_id, source, start, size, sum(n) AS taken, min(slot) AS first_slot, count(*) AS n_slots
        FROM met WHERE n > 0 GROUP BY ALL)
SELECT p.doc_id, p.size, t.source_size, t.target, CAST(coalesce(g.taken, 0) AS BIGINT) AS taken,
       CAST(g.first_slot AS BIGINT) AS first_slot, CAST(coalesce(g.n_slots, 0) AS BIGINT) AS n_slots
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
LEFT JOIN got g ON g.doc_id IS NOT DISTINCT FROM p.doc_id AND g.source IS NOT DISTINCT FROM p.source
  AND g.start = p.start AND g.size = p.size AND p.size > 0
"""
