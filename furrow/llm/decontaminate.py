"""Benchmark decontamination with spaced seeds.

A mask of 1 and 0 is laid over a stretch of words; the words under 1 are hashed, the
words under 0 may differ. Training and benchmark hashes under the same mask are
joined. Around each hit the benchmark item is laid beside the text on the hit's
diagonal and compared word by word: the overlap is the longest stretch that starts and
ends with equal words, has at most ``GAP`` unequal ones in a row and the least share of
equal ones.

Only built-in functions; a text's positions are exploded, hashed and probed in one
stage against the seeds of the benchmark, and only hits are shuffled, folded by
diagonal. A seed is a hash, an item's number, a place and the item's length; the words
of an item join what is folded, so an item of many words is not repeated for each place.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import broadcast_if_small, narrow, native_words
from furrow.session import settle

#: Words under a 1 are read, those under a 0 may differ. Every overlap of 13 words or more
#: with the default share and gaps has a place that one of the masks fits.
MASKS = ("1110111", "11000101101", "11001001011")
#: Seeds of items under 13 words, by their number of words: so many equal words in a row
#: stand in the item whichever fifth of its words differs.
SHORT = {1: 1, 2: 2, 3: 3, 4: 4, 5: 2, 6: 3, 7: 3, 8: 4, 9: 4, 10: 3, 11: 3, 12: 4}
GAP = 2
#: Items of so many bytes together are broadcast; beyond that they are joined by shuffle.
BROADCAST_BYTES = 64_000_000
#: Words that an overlap has at least, and the share of equal ones among them.
LEAST_WORDS, LEAST_SHARE = 13, 0.8


def _hashes(words: Column, at: Column, masks: Sequence[str]) -> Column:
    """One per mask, null where the mask reaches beyond the text."""
    return F.array(
        *[
            F.when(
                at + len(mask) <= F.size(words),
                F.xxhash64(F.lit(mask), *[F.get(words, at + i) for i, bit in enumerate(mask) if bit == "1"]),
            )
            for mask in masks
        ]
    )


def _positions(words: Column) -> Column:
    """0 to the last word; none if there is no word."""
    return F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))


def _stretch(run: Column, least: Column, least_share: float) -> Column:
    """The longest stretch of a run, given by the places of its equal words, that starts and
    ends with one of them and has ``least`` words and ``least_share`` of them equal: its
    number of words, of equal ones, and its start with a minus. Null if there is none.

    A stretch from the i-th to the j-th equal word has the share if the balance (equal
    words less the share of all) behind its end is not below the one before its start.
    Sorted by balance, each end follows the starts that it can have, and the first of
    these gives the longest stretch."""
    of, words = Fraction(str(least_share)).as_integer_ratio()

    def edges(kind: int) -> Column:
        return F.transform(
            run,
            lambda at, i: F.struct(
                ((i + kind).cast("long") * words - (at + kind).cast("long") * of).alias("balance"),
                F.lit(kind).alias("kind"),
                at.alias("at"),
                i.alias("rank"),
            ),
        )

    def step(so_far: Column, edge: Column) -> Column:
        start, n = so_far["start"], edge["at"] - so_far["start"]["at"] + 1
        found = F.struct(n.alias("n"), (edge["rank"] - start["rank"] + 1).alias("n_equal"), (-start["at"]).alias("begin"))
        return F.struct(
            F.when(edge["kind"] == 0, F.least(start, F.struct(edge["at"], edge["rank"]))).otherwise(start).alias("start"),
            F.when((edge["kind"] == 1) & (n >= least), F.greatest(so_far["best"], found)).otherwise(so_far["best"]).alias("best"),
        )

    none = F.struct(
        F.lit(None).cast("struct<at:int,rank:int>").alias("start"), F.lit(None).cast("struct<n:int,n_equal:int,begin:int>").alias("best")
    )
    return F.aggregate(F.array_sort(F.concat(edges(0), edges(1))), none, step, lambda so_far: so_far["best"])


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    least_words: int = LEAST_WORDS,
    least_share: float = LEAST_SHARE,
    masks: Sequence[str] = MASKS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per text, benchmark item and diagonal with a verified overlap: ``doc_id``,
    ``text_hash``, ``item_id``, ``start_word``, ``end_word`` (exclusive), ``n_equal``
    and ``share`` (equal words of the overlap's words).

    An overlap has at least ``least_words`` words, or as many as the item if that is
    shorter, and ``least_share`` of them equal. None is missed down to the default words
    and share; below them other ``masks`` are needed. Items of a few words are found
    wherever these stand. Null and empty texts overlap with nothing. Null ids are
    kept. Rows alike in id and text give one row together; items that share an id are
    one row too, the longest overlap. Words are those of letters, digits and characters
    beyond ASCII, in lower case.
    """
    items = settle(narrow(benchmark, item_id=item_col, text=item_text_col).distinct().select(
        F.monotonically_increasing_id().alias("item_key"), "item_id", native_words(F.col("text")).alias("item"), F.octet_length("text").alias("bytes")
    ))
    lengths = {r["n"] for r in items.where(F.size("item").between(1, max(SHORT))).select(F.size("item").alias("n")).distinct().collect()}
    short = {n: "1" * SHORT[n] for n in sorted(lengths)}
    own = F.when(F.size("item") > max(SHORT), _hashes(F.col("item"), F.col("at"), masks))
    for n, mask in short.items():
        own = own.when(F.size("item") == n, _hashes(F.col("item"), F.col("at"), [mask]))
    seeds = settle(
        items.select("item_key", "item", F.posexplode(_positions(F.col("item"))).alias("_", "at"))
        .select("item_key", F.size("item").alias("n_item"), "at", F.explode(own).alias("seed"))
        .where("seed is not null")
    )
    masks = [*masks, *sorted(set(short.values()))]
    text = narrow(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), native_words(F.col("text")).alias("words")
    )
    w, i = F.col("words"), F.col("i")
    probes = text.select("*", F.explode(_positions(w)).alias("i")).select("*", F.explode(_hashes(w, i, masks)).alias("seed"))
    # Beyond the checked size the seeds are joined by hash like any other table.
    hits = probes.where("seed is not null").join(broadcast_if_small(seeds, 200_000), "seed")
    diagonal = i - F.col("at")
    first = F.greatest(-diagonal, F.lit(0))
    # All hits of one overlap lie on one diagonal and carry the same stretch of the text.
    # They are folded before the comparison, whose lambda would end code generation and
    # make Spark copy the word array for each position.
    beside = F.slice(w, F.greatest(diagonal, F.lit(0)) + 1, F.col("n_item") - first)
    met = (
        hits.select("doc_id", "text_hash", "item_key", diagonal.alias("diagonal"), first.alias("first"), beside.alias("beside"))
        .groupBy("doc_id", "text_hash", "item_key", "diagonal", "first")
        .agg(F.max("beside").alias("beside"))
    )
    whole = items.select("item_key", "item_id", "item")
    small = (items.agg(F.sum("bytes")).first()[0] or 0) <= BROADCAST_BYTES
    folded = met.join(F.broadcast(whole) if small else whole, "item_key").drop("item_key")
    ones = F.filter(F.sequence(F.lit(0), F.size("beside") - 1), lambda i: F.get("beside", i) == F.get("item", F.col("first") + i))
    cuts = F.filter(
        F.sequence(F.lit(0), F.size("ones") - 1), lambda i: (i == 0) | (F.get("ones", i) - F.get("ones", i - 1) > GAP + 1)
    )
    runs = F.transform("cuts", lambda c, k: F.slice("ones", c + 1, F.coalesce(F.get("cuts", k + 1), F.size("ones")) - c))
    least = F.least(F.lit(least_words), F.size("item"))
    best = F.array_max(F.transform("runs", lambda run: _stretch(run, least, least_share)))
    # What is verified is only filtered after the last grouping: a filter here would be
    # pushed down and repeat these expressions, one inside the other.
    verified = (
        folded.withColumn("ones", ones)
        .withColumn("cuts", cuts)
        .withColumn("runs", runs)
        .withColumn("best", best)
        .select(
            "doc_id",
            "text_hash",
            "item_id",
            (F.col("diagonal") + F.col("first") - F.col("best.begin")).alias("start_word"),
            F.when(F.col("best").isNotNull(), F.struct("best.n", "best.n_equal")).alias("found"),
        )
    )
    return verified.groupBy("doc_id", "text_hash", "item_id", "start_word").agg(
        F.max("found").alias("most")
    ).where("most is not null").select(
        "doc_id",
        "text_hash",
        "item_id",
        F.col("start_word").cast("long").alias("start_word"),
        (F.col("start_word") + F.col("most.n")).cast("long").alias("end_word"),
        F.col("most.n_equal").cast("long").alias("n_equal"),
        (F.col("most.n_equal") / F.col("most.n")).alias("share"),
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` without a verified overlap, all columns kept. Rows with a null
    id or text are judged like others: by their text; a null or empty text stays. An empty
    table gives an empty one."""
    found = overlaps(docs, benchmark, id_col=id_col, text_col=text_col, **settings)
    gone = broadcast_if_small(settle(found.select("doc_id", "text_hash").distinct()))
    alike = docs[id_col].eqNullSafe(gone["doc_id"]) & (F.xxhash64(docs[text_col]) == gone["text_hash"])
    return docs.join(gone, alike, "left_anti")
