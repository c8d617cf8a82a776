"""Benchmark decontamination with a distributed positional inverted index.

1. *Statistics.* How often each benchmark word occurs in the training texts.
2. *Probes.* A window is ``WINDOW_WORDS`` consecutive words of an item (the whole item, if it has
   fewer). Its probes are its ``PROBES`` rarest words in training, and one more for each word that a
   proximity match may lack.
3. *Index.* Training postings (word, document, position) of all probe words, stored as Parquet.
4. *Intersection.* A posting less its place in the item is an alignment of item and document. An
   alignment stays if ``PROBES`` probes of at least one window meet in it, each at most ``SLACK`` words
   away.
5. *Verification.* Along what is left, words are compared one by one, in one pass over the texts:
   all of them for exact phrases, all but ``SLACK`` for proximity matches.

The benchmark's word and probe tables are broadcast only behind a check of their stored rows; a
larger benchmark is joined by shuffling words. Postings and alignments are joined by shuffles that
AQE can split, since one passage may occur in a third of all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import bound, sized_broadcast, stored, words_of

WINDOW_WORDS = 13
PROBES = 2
#: Words of a window that a proximity match may lack, and how far each may stand from its place.
SLACK = 1
#: A window of fewer words than this, times the slack, must be matched exactly.
WORDS_A_SLACK = 4


def _items(benchmark: DataFrame) -> DataFrame:
    """Distinct items that have words: item key, item_id as string, words."""
    return (
        benchmark.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
            words_of(F.col("text")).alias("item_words"),
        )
        .where(F.size("item_words") > 0)
        .distinct()
        .withColumn("ik", F.xxhash64("item", "item_words"))
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows equal in doc_id and text are one document to the search."""
    return docs.withColumns(
        {"_k": F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "_t": F.xxhash64("text")}
    )


def probes(items: DataFrame, counts: DataFrame, window: int, n_probes: int) -> DataFrame:
    """(ik, window start, place of each probe): the rarest words of each window."""
    places = items.select("ik", F.size("item_words").alias("n"), F.posexplode("item_words").alias("p", "word"))
    places = places.join(counts, "word", "left").na.fill(0, ["df"])
    last = F.greatest(F.col("n") - window, F.lit(0))
    inside = places.withColumn(
        "start",
        F.explode(F.sequence(F.greatest(F.col("p") - (window - 1), F.lit(0)), F.least(F.col("p"), last))),
    )
    rank = F.row_number().over(Window.partitionBy("ik", "start").orderBy("df", "p"))
    return (
        inside.withColumn("rank", rank)
        .where(F.col("rank") <= n_probes)
        .select("ik", "start", "p", "word")
    )


def _slack(n_words: Column, slack: int) -> Column:
    """The slack of a window of so many words."""
    return F.least(F.lit(slack), F.floor(n_words / WORDS_A_SLACK)).cast("int")


def alignments(docs: DataFrame, items: DataFrame, window: int, n_probes: int, slack: int = 0) -> DataFrame:
    """Distinct (document, item, shift) in which probes of some window meet.

    Of its probes, all but the slack do, each at most the slack away from its place.
    """
    texts = docs.select("_k", "_t", words_of(F.col("text")).alias("words"))
    vocabulary = stored(items.select(F.explode("item_words").alias("word")).distinct(), "bench-words")
    n_words = vocabulary.count()
    counts = (
        texts.select(F.explode("words").alias("word"))
        .join(sized_broadcast(vocabulary, 64, n_words), "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    found = stored(probes(items, counts, window, n_probes + slack), "bench-probes")
    terms = stored(found.select("word").distinct(), "bench-terms")
    index = stored(
        texts.select("_k", "_t", F.posexplode("words").alias("pos", "word")).join(
            sized_broadcast(terms, 64, terms.count()), "word"
        ),
        "postings",
    )
    # a probe place serves many windows; an alignment is made once for it
    spots = stored(found.select("word", "ik", "p").distinct(), "bench-spots")
    near = (
        index.join(sized_broadcast(spots, 96, spots.count()), "word")
        .select("_k", "_t", "ik", (F.col("pos") - F.col("p")).alias("shift"), "p")
    )
    if slack:
        # shuffled before each posting is spread over the alignments that it may serve
        shifts = F.array(*[F.col("shift") + k for k in range(-slack, slack + 1)])
        near = near.repartition("_k", "_t", "ik").withColumn("shift", F.explode(shifts))
    met = near.groupBy("_k", "_t", "ik", "shift").agg(F.collect_set("p").alias("met"))
    needs = stored(
        found.groupBy("ik", "start")
        .agg(F.sort_array(F.collect_set("p")).alias("need"))
        .groupBy("ik")
        .agg(F.collect_set("need").alias("needs")),
        "bench-needs",
    )
    # as many probes as are left when the slack takes its words
    length = F.least(F.col("n_words"), F.lit(window))
    least = F.least(length, F.lit(n_probes) + slack) - _slack(length, slack)
    whole = F.exists("needs", lambda need: F.size(F.array_intersect(need, F.col("met"))) >= least)
    needs = needs.join(items.select("ik", F.size("item_words").alias("n_words")), "ik")
    return met.join(sized_broadcast(needs, 4096, needs.count()), "ik").where(whole).select("_k", "_t", "ik", "shift")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    n_probes: int = PROBES,
    slack: int = SLACK,
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256, contaminated, spans, near_spans and near_items.

    ``spans`` are the word ranges (start, end exclusive) of the exact phrase matches. A document
    is contaminated if at least a twentieth of its words are hit. ``near_spans`` are the word ranges
    of proximity matches, ``near_items`` the sorted names of their items: a window matches if all of its
    words but ``slack`` stand at most ``slack`` words away from their places in it. So exact matches
    are proximity matches, and windows of under four words a slack have no others. Null and empty texts have no
    words and no hits. Repeated documents get equal results, repeated items count once, items
    without words match nothing, a null item_id is written "null". Input columns with a result's
    name are replaced, others pass through.
    """
    results = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "near_spans", "near_items"]
    base = _keyed(docs.drop(*results))
    items = stored(_items(benchmark), "bench-items")
    found = alignments(base, items, window, n_probes, slack)
    candidates = (
        found.join(sized_broadcast(items, 4096, items.count()), "ik")
        .groupBy("_k", "_t")
        .agg(F.collect_list(F.struct("item", "item_words", "shift")).alias("_cands"))
    )

    def matches(cand: Column) -> Column:
        """Starts in the item of windows that occur along the alignment, with their length."""
        words, shift = cand["item_words"], cand["shift"]
        length = F.least(F.size(words), F.lit(window))
        starts = F.sequence(F.lit(0), F.size(words) - length)
        hit = F.filter(
            starts,
            lambda s: (s + shift >= 0)
            & (F.slice(F.col("_words"), F.greatest(s + shift, F.lit(0)) + 1, length) == F.slice(words, s + 1, length)),
        )
        # where each word of the item stands, nearest first; null if it does not
        places = F.transform(
            words,
            lambda word, p: F.coalesce(
                *[
                    F.when(F.get(F.col("_words"), p + shift + k) == word, p + shift + k)
                    for k in sorted(range(-slack, slack + 1), key=abs)
                ]
            ),
        )
        held = F.transform(starts, lambda s: F.filter(F.slice(places, s + 1, length), lambda at: at.isNotNull()))
        near = F.filter(held, lambda at: F.size(at) >= length - _slack(length, slack))
        return F.struct(
            cand["item"].alias("item"),
            F.transform(near, lambda at: F.struct(F.array_min(at).alias("start"), (F.array_max(at) + 1).alias("end"))).alias("near"),
            F.transform(hit, lambda s: F.struct((s + shift).alias("start"), (s + shift + length).alias("end"))).alias("spans"),
        )

    hits = F.filter(
        F.transform(F.coalesce("_cands", F.expr("cast(array() as array<struct<item:string,item_words:array<string>,shift:int>>)")), matches),
        lambda h: F.size(h["near"]) > 0,
    )
    exact = F.filter("_hits", lambda h: F.size(h["spans"]) > 0)
    covered = F.array_distinct(
        F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["end"] - 1)))
    )
    names = F.array_sort(F.array_distinct(F.transform(exact, lambda h: h["item"])))
    joined = base.join(candidates, ["_k", "_t"], "left")
    return (
        bound(bound(joined, "_words", words_of(F.col("text"))), "_hits", hits)
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "spans": F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda h: h["spans"])))),
                "near_spans": F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda h: h["near"])))),
                "near_items": F.array_sort(F.array_distinct(F.transform("_hits", lambda h: h["item"]))),
                "n_items": F.size(names).cast("long"),
                "items_sha256": F.sha2(F.array_join(names, ","), 256),
            }
        )
        .withColumn("n_hit", F.size(covered).cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))
        .select(*[F.col(f"`{c}`") for c in docs.columns if c not in results], *results)
    )
