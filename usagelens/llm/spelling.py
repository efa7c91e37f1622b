"""Groups of spelling variants: words one edit apart, found through asymmetric q-chunks.

Of two words the longer one is cut into two disjoint chunks, and one edit leaves at least one of them
whole in the other word. The other word offers its grams of the chunks' sizes at the places where a
whole chunk can lie: the first chunk stays at its place, the last one is shifted by the difference of
the lengths, which is one at most. Half a word is common to many words, so the chunk that the edit fell
into is cut in two again by the same rule: what is left whole is the word without one of four chunks.
Words meet on that, together with the length and the chunk that is left out, and every meeting is
verified. Nothing is lost, and words that meet differ within a quarter of their length only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import LOWER, UPPER
from usagelens.session import materialize

#: Letters of words: ASCII and the upper half of Latin-1, all of one UTF-16 unit.
LETTERS = "A-Za-zÀ-ÿ"
CHUNKS = 4


def counted_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7,
                  typo_every: int | None = None) -> DataFrame:
    """(word, n): the maximal runs of letters of all texts with ``least`` letters or more.

    Only A-Z are lower-cased. With ``typo_every`` the run loses the letter ``h % length`` where that
    number divides h, the crc32 of ``<key>:<run>``; a null key is written as nothing. Counted are the
    runs as they then are. Null, empty and blank texts have no words; repeated rows count again.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    word = rows.select("id", F.translate("run", UPPER, LOWER).alias("word"))
    if typo_every:
        hashed = word.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word")))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
        word = hashed.select(F.when(F.col("h") % typo_every == 0, cut).otherwise(F.col("word")).alias("word"))
        word = word.where(F.length("word") >= least)
    return word.groupBy("word").agg(F.count("*").alias("n"))


def without_chunk(word: Column, length: Column, shift: int) -> Column:
    """Hashes of ``word`` without each of the four chunks of a word of ``length``.

    ``shift`` is what the word itself is longer than that, so its end is read from there on.
    """
    half = F.floor(length / 2)
    cuts = [F.lit(0), F.floor(half / 2), half, half + F.floor((length - half) / 2), length]
    kept = [(F.substring(word, F.lit(1), cuts[k].cast("int")),
             F.substring(word, (cuts[k + 1] + shift + 1).cast("int"), length.cast("int")))
            for k in range(CHUNKS)]
    return F.array(*[F.xxhash64(F.lit(k), length, first, last) for k, (first, last) in enumerate(kept)])


def near_words(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): each pair of distinct ``words`` (word, n) that are one edit apart, once.

    An edit inserts, deletes or replaces one code point. A word meets those of its own length, and
    those one shorter, by what is left without one chunk; equal hashes of different remains are ruled
    out by the verification.
    """
    sized = words.select("word", "n", F.length("word").cast("long").alias("size"))
    own = sized.select("word", "n", "size", F.explode(without_chunk(F.col("word"), F.col("size"), 0)).alias("at"))
    grams = F.concat(without_chunk(F.col("word"), F.col("size"), 0),
                     without_chunk(F.col("word"), F.col("size") + 1, -1))
    other = sized.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.explode(grams).alias("at"))
    met = own.select(F.col("word").alias("a"), F.col("n").alias("n_a"), "size", "at").join(other, "at")
    longer = F.col("size") > F.length("b")
    near = met.where((longer | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    # An edit within a run of one letter can be laid into either of two chunks.
    return near.select("a", "n_a", "b", "n_b").dropDuplicates(["a", "b"])


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of ``forms`` (word, form) that starts at each word ends.

    Chains have no circle. Their length halves with each step, and the steps are written out.
    """
    links = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = links.join(ahead, "root", "left")
        if stepped.where("further is not null").isEmpty():
            return links
        links = materialize(stepped.select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of ``words`` (word: distinct, n: its count).

    ``n_near`` counts the words one edit apart. The one of largest count, ties to the least in
    code-point order, is the word's form if its count is at least ``ratio`` times the word's own; else
    form and form_n are null. ``root`` is where the forms lead to, the word itself if it has none.
    Counts grow along a chain by ``ratio``, 2 at least, so chains end. An empty table gives an empty
    one; other columns of ``words`` are not read.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = materialize(words.where("word is not null").select("word", "n"), "spelling-words")
    near = materialize(near_words(words), "spelling-near")
    both = near.select(F.col("a").alias("word"), F.col("b").alias("form"), F.col("n_b").alias("form_n")).union(
        near.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("order"), "form")).alias("best"))
    judged = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.order") >= ratio * F.col("n"), F.col("best")).alias("best"))
    judged = materialize(judged.select(
        "word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.order")).alias("form_n")),
        "spelling-judged")
    roots = last_forms(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
