"""SpotSigs fingerprints: chains of content words behind common-word anchors.

A text is lower-cased and read as words of letters and digits. Behind each anchor (a very common
word) the next ``CHAIN`` content words, stop words between them left out, form a signature together with
the anchor. The fingerprint is the sorted set of the signatures' hashes; a text without any signature
has the hash of its words, and a text without words the empty set. Fingerprints are compared by
Jaccard similarity, pruned by their lengths: two sets whose lengths differ by more than the threshold
allows cannot be alike enough, so only neighbouring length classes meet and the others are not intersected.

All steps are column expressions. ``with_next`` finds each row's successor in id order by windows over
blocks of ids and one small join of the blocks' borders, so no task orders all rows.

Edge cases: null text counts as empty; two empty sets are alike (1), an empty and another set are not
(0); a null id comes after all others; repeated rows follow each other in text order; a single row is
its own successor; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressgauge.llm.common import text_or_empty

CHAIN = 2
BLOCK_IDS = 1024
ANCHORS = "the of and to in a is that der die und le la les et que el los las de en un".split()
STOPS = [
    *ANCHORS,
    *"an was be by for on with as at are this it from or he she not have den dem des das von zu ist ein eine auf mit für".split(),
    *"des du une dans pour par sur est au aux avec qui pas il se su con por para no lo una y o es al".split(),
]


def words(text: str | Column) -> Column:
    """The words of a text, each with one space before and behind."""
    spaced = F.regexp_replace(F.lower(text_or_empty(text)), r"[^\p{L}\p{N}]+", " ")
    return F.concat(F.lit(" "), F.trim(spaced), F.lit(" "))


def signatures(text: str | Column) -> Column:
    """The fingerprint as a sorted array of 32-bit hashes, held in longs.

    The stop words before each content word are cut out as its run; every anchor in the run heads the
    chain that begins with that word. No pattern repeats a group, so its stack does not grow with the text.
    """
    stop = "(?:" + "|".join(dict.fromkeys(STOPS)) + ")"
    low = F.lit(0xFFFFFFFF)

    def linked(line: Column, content: Column) -> Column:
        runs = F.split(F.regexp_replace(line, f"(?<= )(?!{stop} )[^ ]+ ", "\u0001"), "\u0001")
        later = [F.slice(content, F.lit(i + 1), F.greatest(F.size(content) - i, F.lit(0))) for i in range(CHAIN)]
        zipped = F.arrays_zip(runs.alias("run"), *(c.alias(f"c{i}") for i, c in enumerate(later)))
        return F.filter(zipped, lambda z: (F.trim(z["run"]) != "") & z[f"c{CHAIN - 1}"].isNotNull())

    def heads(z: Column) -> Column:
        anchors = F.filter(F.split(F.trim(z["run"]), " "), lambda w: w.isin(*dict.fromkeys(ANCHORS)))
        return F.transform(F.array_distinct(anchors), lambda w: F.xxhash64(w, *(z[f"c{i}"] for i in range(CHAIN))).bitwiseAND(low))

    def chains(line: Column) -> Column:
        content = F.filter(F.split(F.regexp_replace(line, f"(?<= ){stop} ", ""), " "), lambda w: w != "")
        return _once(content, lambda c: F.array_sort(F.array_distinct(F.flatten(F.transform(linked(line, c), heads)))))

    def either(line: Column) -> Column:
        whole = F.when(F.trim(line) == "", F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(line).bitwiseAND(low)))
        return _once(chains(line), lambda found: F.when(F.size(found) > 0, found).otherwise(whole))

    return _once(words(text), either)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def shown(signs: str | Column) -> Column:
    """The fingerprint as a string: eight hexadecimal digits a signature."""
    return F.array_join(F.transform(signs, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def length_class(signs: str | Column, at_least: float) -> Column:
    """Classes of set length: sets with a similarity of ``at_least`` lie in the same or the next one."""
    return F.floor(F.log(F.greatest(F.size(signs), F.lit(1))) / -F.log(F.lit(at_least))).cast("int")


def likeness(one: str | Column, two: str | Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity; 0 without intersecting where the lengths rule ``at_least`` out."""
    a, b = F.size(one), F.size(two)
    common = F.size(F.array_intersect(one, two))
    bound = F.least(a, b) / F.greatest(a, b)
    return (
        F.when(F.greatest(a, b) == 0, F.lit(1.0)).when(bound < at_least, F.lit(0.0)).when(F.least(a, b) == 0, F.lit(0.0))
        .otherwise(common / (a + b - common))
    )


def with_next(
    rows: DataFrame, id_col: str, order: list[Column], columns: list[str], inside_only: tuple[str, ...] = (), block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Add next_ + c for each of ``columns`` from the row after, in descending id; after the last comes the first.

    ``order`` decides among equal ids. Rows are shuffled by blocks of ids; the first row of each block
    goes to the block above. Columns ``inside_only`` come along within a block and are null at its border.
    """
    block = F.coalesce(F.floor(F.col(id_col) / block_ids), F.lit(-(1 << 62))).cast("long")
    inside = Window.partitionBy("_block").orderBy(F.desc_nulls_last(id_col), *order)
    held = rows.withColumn("_block", block)
    moved = F.struct(*columns, *inside_only)
    placed = held.select("*", F.lead(moved).over(inside).alias("_next"))
    blocks = held.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    downwards = Window.orderBy(F.desc("_block"))
    after = blocks.select(F.col("_block").alias("_of"), F.coalesce(F.lead("_block").over(downwards), F.max("_block").over(Window.partitionBy())).alias("_block"))
    ranked = held.select("_block", F.struct(*columns).alias("_first"), F.row_number().over(inside).alias("_place"))
    firsts = ranked.where("_place = 1").join(after, "_block").select(F.col("_of").alias("_block"), "_first")
    joined = placed.join(firsts, "_block", "left")
    added = [F.when(F.col("_next").isNull(), F.col(f"_first.{c}")).otherwise(F.col(f"_next.{c}")).alias(f"next_{c}") for c in columns]
    return joined.select(*rows.columns, *added, *(F.col(f"_next.{c}").alias(f"next_{c}") for c in inside_only))


def edited(text: str, other: str) -> Column:
    """``text`` with its last half of code points replaced by the first as many, or all, of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, signs of every document."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("signs", signatures("text"))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.0) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    linked = with_next(fingerprints(docs, id_col, text_col), "doc_id", [F.asc("text")], ["text"], ("signs",))
    linked = linked.withColumn("next_signs", F.coalesce("next_signs", signatures("next_text")))
    other = linked.withColumn("edited", edited("text", "next_text")).withColumn("edited_signs", signatures("edited"))
    return other.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        shown("signs").alias("fingerprint"), shown("edited_signs").alias("edited_fingerprint"),
        likeness("signs", "edited_signs", at_least).alias("near_edited"), likeness("signs", "next_signs", at_least).alias("near_next"),
    )
