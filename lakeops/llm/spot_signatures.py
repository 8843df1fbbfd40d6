"""SpotSigs: fingerprints made of the chains of content words that follow common words."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.components import components
from lakeops.llm.leaders import candidates, unlike
from lakeops.operators.windows import ordered_window
from lakeops.session import written

# Common words that anchor a chain, in English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has he in is it its of on or that the this to was were will with you "
    "als auch auf aus das dem den der des die ein eine einer es für im ist mit nicht sich und von wie zu "
    "au aux avec ce dans de du elle en est et il la le les par pas pour qui que se sur un une "
    "al como con del el las lo los más no por su sus una y"
).split()
#: Content words in a chain, and words after an anchor in which they are looked for.
CHAIN, REACH = 2, 8
THRESHOLD = 0.8


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case; none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def signatures(text: Column) -> Column:
    """The distinct signatures of a text as hashes in order.

    A signature is an anchor and the next CHAIN words that are no anchors. A text without a whole chain has one
    signature, made of all its words, so it is like no text but those of the same words.
    """

    def chain(tokens: Column, anchor: Column, place: Column) -> Column:
        following = F.filter(F.slice(tokens, place + 2, REACH), lambda w: ~w.isin(ANCHORS))
        return F.when(F.size(following) >= CHAIN, F.xxhash64(anchor, F.slice(following, 1, CHAIN)))

    def of(tokens: Column) -> Column:
        found = F.array_compact(F.transform(tokens, lambda word, i: F.when(word.isin(ANCHORS), chain(tokens, word, i))))
        return F.when(F.size(found) > 0, F.array_sort(F.array_distinct(found))).otherwise(F.array(F.xxhash64(tokens)))

    # A lambda's variable holds the words, so that they are cut once and not once per use.
    return F.get(F.transform(F.array(words(text)), of), 0)


def likeness(one: Column, two: Column) -> Column:
    """Jaccard similarity of two sets of signatures, 0 to 1; null where one is null."""
    shared = F.size(F.array_intersect(one, two))
    return shared / (F.size(one) + F.size(two) - shared)


def fingerprint(sigs: Column) -> Column:
    """All signatures of a set as one hexadecimal digest."""
    return F.sha2(F.array_join(sigs.cast("array<string>"), ","), 256)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``signatures`` of every row. Null and empty texts have the signature of no words."""
    return docs.select("doc_id", signatures(F.col("text")).alias("signatures"))


def _with_next(docs: DataFrame) -> DataFrame:
    """Each text with the head of the next document by ascending id, and that document's signatures.

    Only ids and lengths are put in order; texts then meet by id, and of the next text only as much moves as its
    predecessor takes: half as many characters as that has.
    """
    mark = F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark")
    place = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("place")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), place, mark)
    narrow = written(rows.select("place", "mark", F.char_length("text").alias("n")).distinct(), "text-lengths")
    last = narrow.agg(F.max(F.struct("place", "mark", "n")).alias("last")).first()["last"]
    end = (last["place"], last["mark"], last["n"]) if last else (0, 0, 0)
    names = {"before_place": "place", "before_mark": "mark", "before_n": "n"}
    order = ordered_window(narrow, ["place", "mark"], previous=names, sample_every=16).select(
        "place", "mark", *(F.coalesce(name, F.lit(value)).alias(name) for name, value in zip(names, end))
    )
    known = rows.join(order, ["place", "mark"])
    heads = known.select(
        F.col("before_place").alias("place"),
        F.col("before_mark").alias("mark"),
        F.col("text").substr(F.lit(1), F.floor(F.col("before_n") / 2).cast("int")).alias("head"),
        signatures(F.col("text")).alias("next_signatures"),
        F.col("doc_id").alias("next_doc_id"),
    )
    one = heads.groupBy("place", "mark").agg(F.first(F.struct("head", "next_signatures", "next_doc_id")).alias("next"))
    # Both sides come from the same join, so the texts move once.
    return known.select("doc_id", "text", "place", "mark").join(one, ["place", "mark"]).select("doc_id", "text", "next.*")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they and the next document's are.

    The edited text ends with the head of the next document by ascending id instead of its own last half; after the
    last id comes the first. A null id comes before all others, null texts are empty, repeated rows are one document
    with as many result rows, rows of one id and different texts follow each other in a fixed order.
    """
    sigs = _with_next(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))
    kept = F.col("text").substr(F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int"))
    sigs = sigs.select(
        "doc_id",
        "n_chars",
        "next_doc_id",
        "next_signatures",
        signatures(F.col("text")).alias("own"),
        F.concat(kept, "head").alias("edited"),
    ).withColumn("theirs", signatures(F.col("edited")))
    return sigs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("theirs")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("theirs")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_signatures")).alias("near_next"),
        "next_doc_id",
    )


def like_classes(prints: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id`` and ``class_id`` (the smallest id of its class) for every row of ``prints`` (doc_id, signatures).

    Sets are partitioned by length, so that sets of similarity ``threshold`` lie in the same or neighbouring
    partitions. A set need only be found by its ``n - ceil(threshold * n) + 1`` rarest signatures, of which two
    similar sets share one. Candidates are pruned by their lengths and then compared. Equal sets are one set from the
    start. A signature that many sets share pairs them with few leaders first, and then those sets with each other that
    are still in different classes. Null ids have a null
    class, repeated rows a row each, an empty table gives an empty result.
    """
    rows = prints.filter("doc_id IS NOT NULL").withColumn("digest", fingerprint(F.col("signatures")))
    sets = written(
        rows.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("signatures").alias("signatures")), "signature-sets"
    )
    each = sets.select("id", F.explode("signatures").alias("signature"))
    counts = each.groupBy("signature").agg(F.count("*").alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct("n", "signature")))["signature"].alias("ranked")
    ordered = each.join(counts, "signature").groupBy("id").agg(ranked)
    n = F.size("ranked")
    part = F.floor(F.log(n.cast("double")) / -math.log(threshold)).cast("bigint")
    first = F.slice("ranked", F.lit(1), (n - F.ceil(n * threshold - 1e-9) + 1).cast("int"))
    probes = F.concat(F.transform(first, lambda s: F.xxhash64(s, part)), F.transform(first, lambda s: F.xxhash64(s, part + 1)))
    sizes = (F.size("a_sigs"), F.size("b_sigs"))
    similar = (F.least(*sizes) >= F.greatest(*sizes) * threshold) & (likeness(F.col("a_sigs"), F.col("b_sigs")) >= threshold)

    def linked(pairs: DataFrame) -> DataFrame:
        sides = [sets.select(F.col("id").alias(s), F.col("signatures").alias(f"{s}_sigs")) for s in "ab"]
        found = reduce(lambda left, side: left.join(side, side.columns[0]), sides, pairs).filter(similar).select("a", "b")
        return written(found, "signature-links")

    pairs, rest = candidates(ordered.select("id", probes.alias("bands")))
    links = linked(written(pairs, "signature-pairs"))
    labels = components(links)
    open_ = written(unlike(rest, labels), "signature-buckets-open")
    one, two = (open_.select("band", F.col("id").alias(s), F.col("label").alias(f"{s}_label")) for s in "ab")
    others = one.join(two, "band").filter("a < b AND a_label <> b_label").select("a", "b").distinct()
    missing = linked(written(others, "signature-pairs-open"))
    if not missing.isEmpty():
        labels = components(links.union(missing))
    named = sets.join(labels, "id", "left").select("digest", F.coalesce("label", "id").alias("class_id"))
    shown = prints.withColumn("digest", fingerprint(F.col("signatures"))).join(named, "digest", "left")
    return shown.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"))
