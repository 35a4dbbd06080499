"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources, ordered by code point with null last, weigh ``weights`` in turn and
share ``total_share`` of all words; a target stops at ``max_repeats`` times
its source's words, and the excess goes to the other sources by weight until
none is above.  Words are dealt in blocks of ``block`` words:

1. blocks go to sources by highest quotients target / (2k - 1);
2. a source's blocks go to its shards (documents by a seeded hash, about
   ``SHARD_WORDS`` words each) in the same way, by the shards' words;
3. a shard's stream of documents, in seeded order, is cut into blocks.  The
   quota takes every block as often as it goes, and the rest selects blocks
   evenly over the stream from a seeded start: block j of n goes if
   floor(((j + 1) r + s) / n) > floor((j r + s) / n), which is r of n for any
   s, and gives the words taken from a document in closed form.

One task sees one row a source (targets and quotas), or one row a shard of
one source; documents meet in shards, whose number follows a source's words
and rows, so a source with a third of all rows just has more shards, and rows
that repeat (a null id with one text) are spread over them in runs.  A shard's quota is at most
``max_repeats`` passes, so no document is taken more often.

Cases: a null source is a source of its own, an empty one another; null and
blank texts have size 0 and are never taken; rows that repeat are dealt
separately (each is a row of the stream); an empty table gives no rows; if
no document has words nothing is taken.  Reruns agree, since order and
selection come from hashes of the seed, the id and the text.  Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.store import free_name, keep

WEIGHTS = (5, 2, 1)
TOTAL_SHARE, MAX_REPEATS = 1.5, 2
BLOCK, SEED = 8, 20240607
#: A shard's size: about so many words, and so many documents (empty ones count too).
SHARD_WORDS, SHARD_ROWS = 500_000, 20_000
#: Rows that repeat go to the shards in runs of so many.
RUN = 1000


def _hash(*parts) -> Column:
    """MD5 of the seed and the parts: a hash that any SQL engine has."""
    return F.md5(F.concat_ws("|", F.lit(str(SEED)), *parts))


def _number(h, start: int) -> Column:
    """Eight hex digits of a hash as a number."""
    return F.conv(F.substring(h, start, 8), 16, 10).cast("long")


def _row_hash(id_col: str, text_col: str) -> Column:
    return _hash(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit("")))


def sizes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        _row_hash(id_col, text_col).alias("h"))


def targets(by_source: DataFrame, weights: tuple = WEIGHTS, total_share: float = TOTAL_SHARE,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target from one row (source, source_size) each.

    Sources reach their cap in the order of cap / weight.  With the j lowest
    capped, the others have (total - their caps) / (their weights) words a
    unit of weight; the right j is the first at which the next one fits."""
    every = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    w = (by_source.withColumn("weight", weight)
         .withColumn("cap", (max_repeats * F.col("source_size")).cast("double"))
         .withColumn("total", F.sum("source_size").over(every) * F.lit(float(total_share))))
    in_order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    w = (w.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("unit", (F.col("total") - F.col("capped")) / F.col("left"))
         .withColumn("fits", F.col("unit") * F.col("weight") <= F.col("cap")))
    unit = F.first(F.when(F.col("fits"), F.col("unit")), ignorenulls=True).over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return w.withColumn("unit", unit).select(
        "source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("unit") * F.col("weight"), F.col("cap"))).alias("target"))


def sainte_lague(claims: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Give ``seats`` (one value in each group of ``keys``) to the rows of the
    group by the highest quotients claim / (2k - 1); ``name`` orders equal
    quotients.  Adds ``quota``.

    The divisor total / (seats - rows / 2) surely gives out no seat too many
    and settles all but a few of every row; at most about three quotients a
    row are left to be ranked."""
    group = Window.partitionBy(*keys)
    c = (claims.withColumn("_total", F.sum("claim").over(group)).withColumn("_rows", F.count("*").over(group))
         .withColumn("_few", F.expr("seats - _rows / 2"))
         .withColumn("_sure", F.expr(
             "CASE WHEN _few > 0 AND _total > 0 THEN floor(claim * _few / _total + 0.5) ELSE 0L END"))
         .withColumn("_open", F.col("seats") - F.sum("_sure").over(group))
         .withColumn("_more", F.expr(
             "CASE WHEN claim > 0 THEN ceil(claim * least(_rows, seats + _rows / 2) / _total) + 2 ELSE 0L END")))
    quotients = (c.where("_more > 0 AND _open > 0")
                 .select(*keys, name, "claim", "_open", F.explode(F.expr("sequence(_sure + 1, _sure + _more)")).alias("_seat"))
                 .withColumn("_q", F.expr("claim / (2 * _seat - 1)")))
    won = (quotients.withColumn("_place", F.row_number().over(group.orderBy(F.desc("_q"), name, "_seat")))
           .where("_place <= _open").groupBy(*keys, name).agg(F.count("*").alias("_won")))
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"w.{k}")) for k in [*keys, name]]
    return c.alias("c").join(won.alias("w"), same, "left").select(
        *(F.col(f"c.{x}") for x in claims.columns),
        (F.col("c._sure") + F.coalesce("w._won", F.lit(0))).cast("long").alias("quota"))


def _streams(documents: DataFrame, weights: tuple, total_share: float, max_repeats: int, block: int, id_col: str, text_col: str,
             source_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows with words, each with its place in its shard's stream (offset
    ``o``, first and last block ``a`` and ``e``) and the shard's selection
    (``n`` blocks, ``passes`` of all and ``r`` more from seed ``s``); and the
    rows without words, as ``mix`` returns them."""
    docs = keep(sizes(documents, id_col, text_col, source_col), "sizes")
    by_source = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    goals = targets(by_source.select("source", "source_size"), weights, total_share, max_repeats)
    of_source = (sainte_lague(goals.withColumn("claim", F.col("target")).withColumn(
                     "seats", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")), [], "source")
                 .drop("claim", "seats").alias("g")
                 .join(by_source.select("source", "n_docs").alias("n"), F.expr("g.source <=> n.source"))
                 .select("g.*", F.expr(f"CAST(ceil(g.source_size / {SHARD_WORDS} + n.n_docs / {SHARD_ROWS}) AS BIGINT)")
                         .alias("n_shards")))
    of_source = keep(of_source, "quotas")
    # rows that repeat are one entry with a count, cut into runs that go to
    # shards of their own; rows without words need no shard
    runs = (docs.where("size > 0").groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("n_rows"))
            .withColumn("run", F.explode(F.expr(f"sequence(0L, (n_rows - 1) div {RUN})")))
            .withColumn("copies", F.expr(f"least({RUN}, n_rows - run * {RUN})")))
    of_run = F.when(F.col("d.run") == 0, F.col("d.h")).otherwise(_hash(F.col("d.h"), F.col("d.run").cast("string")))
    dealt = (runs.alias("d").join(of_source.select("source", "n_shards").alias("s"), F.expr("d.source <=> s.source"))
             .select("d.*", (_number(of_run, 25) % F.col("s.n_shards")).alias("shard")))
    of_shard = (dealt.groupBy("source", "shard").agg(F.sum(F.expr("size * copies")).alias("shard_words")).alias("d")
                .join(of_source.alias("s"), F.expr("d.source <=> s.source"))
                .select("d.*", "s.source_size", "s.target", F.col("s.quota").alias("seats"))
                .withColumn("claim", F.col("shard_words").cast("double")))
    blocks = F.expr(f"CAST(ceil(shard_words / {block}) AS BIGINT)")
    shards = (sainte_lague(of_shard, ["source"], "shard")
              .withColumn("n", F.greatest(blocks, F.lit(1).cast("long")))
              .withColumn("q", F.least("quota", max_repeats * F.col("n")))
              .withColumn("passes", F.expr("q div n")).withColumn("r", F.expr("q % n"))
              .withColumn("s", _number(_hash(F.coalesce("source", F.lit("")), F.col("shard").cast("string")), 1) % F.col("n")))
    stream = Window.partitionBy("source", "shard").orderBy("h", "doc_id", "size", "run")
    placed = (dealt.withColumn("_o", F.coalesce(F.sum(F.expr("size * copies")).over(
                  stream.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
              .withColumn("_i", F.explode(F.expr("sequence(0L, copies - 1)"))).withColumn("o", F.expr("_o + _i * size")))
    at = (placed.alias("p").join(shards.drop("claim").alias("s"),
                                 F.expr("p.source <=> s.source AND p.shard = s.shard"))
          .select("p.doc_id", "p.h", "p.size", "p.o", "s.source_size", "s.target", "s.n", "s.passes", "s.r", "s.s")
          .withColumn("a", F.expr(f"o div {block}")).withColumn("e", F.expr(f"(o + size - 1) div {block}")))

    blank = (docs.where("size = 0").alias("d").join(of_source.alias("s"), F.expr("d.source <=> s.source"))
             .select("d.doc_id", F.col("d.h").alias("t"), "d.size", "s.source_size", "s.target", F.lit(0).cast("long").alias("taken")))
    return at, blank


def _before(j: str) -> str:
    """Selected blocks before block j."""
    return f"((({j}) * r + s) div n)"


def _picked(j: str) -> str:
    return f"({_before(f'{j} + 1')} - {_before(j)})"


def mix(documents: DataFrame, weights: tuple = WEIGHTS, total_share: float = TOTAL_SHARE,
        max_repeats: int = MAX_REPEATS, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """doc_id, t (a hash of seed, id and text), size, source_size, target, taken of every row."""
    at, blank = _streams(documents, weights, total_share, max_repeats, block, id_col, text_col, source_col)
    part = F.expr(f"""CASE WHEN a = e THEN {_picked('a')} * size
        ELSE {_picked('a')} * ((a + 1) * {block} - o) + {_picked('e')} * (o + size - e * {block})
             + {block} * ({_before('e')} - {_before('a + 1')}) END""")
    return at.select("doc_id", F.col("h").alias("t"), "size", "source_size", "target",
                     (F.col("passes") * F.col("size") + part).cast("long").alias("taken")).unionAll(blank)


def mixed_blocks(documents: DataFrame, weights: tuple = WEIGHTS, total_share: float = TOTAL_SHARE,
                 max_repeats: int = MAX_REPEATS, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source") -> DataFrame:
    """What the mix takes, for a writer of training data: doc_id, t, first_word
    and last_word (from 0) and how many ``times``, one row for each part of a
    row's text in a selected block.  The words of a row's parts, with their
    times, add up to its ``taken``."""
    at, _ = _streams(documents, weights, total_share, max_repeats, block, id_col, text_col, source_col)
    parts = (at.withColumn("j", F.explode(F.expr("sequence(a, e)"))).withColumn("times", F.expr(f"passes + {_picked('j')}"))
             .where("times > 0"))
    return parts.select("doc_id", F.col("h").alias("t"), F.expr(f"greatest(j * {block} - o, 0L)").alias("first_word"),
                        F.expr(f"least((j + 1) * {block} - o, size) - 1").alias("last_word"), "times")


def mixed_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **how) -> DataFrame:
    """The documents that the mix takes words of, with ``taken`` added; it
    takes the place of a column of that name.  Rows that repeat share their
    words evenly, rounded up."""
    d, t, n = (free_name(documents, stem) for stem in ("d", "t", "n"))
    counts = (mix(documents, id_col=id_col, text_col=text_col, source_col=source_col, **how)
              .groupBy(F.col("doc_id").alias(d), F.col("t").alias(t))
              .agg(F.ceil(F.sum("taken") / F.count("*")).alias(n)).where(F.col(n) > 0))
    docs = documents.withColumn(f"{t}_own", _row_hash(id_col, text_col)).withColumn(f"{d}_own", F.col(id_col).cast("long"))
    same = (F.col(f"{t}_own") == F.col(t)) & F.col(f"{d}_own").eqNullSafe(F.col(d))
    return docs.join(counts, same).select(*(F.col(f"`{c}`") for c in documents.columns if c != "taken"), F.col(n).alias("taken"))


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
