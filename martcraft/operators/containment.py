"""Which words of a dictionary lie inside a text, as equality joins (JN11, JN12).

Enumerating every substring of a text is quadratic in its length.  Here the dictionary is indexed by
the first ``GRAM`` characters of its words, each with the lengths that its words have.  A text's grams
are a row per place, and only where a gram starts some word are substrings cut, one per
length listed there.  The work grows with the text's length times the lengths that really occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3


def word_index(words: DataFrame, word: str, scope: tuple[str, ...] = ()) -> DataFrame:
    """(scope..., _gram, _lens): the lengths of the words that start with each gram."""
    return (words.filter(F.col(word) != "").groupBy(*scope, F.substring(word, 1, GRAM).alias("_gram"))
            .agg(F.collect_set(F.length(word)).alias("_lens")))


def candidate_parts(texts: DataFrame, text: str, index: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """(scope..., text, part): the distinct parts of each distinct text that start like a word and are as long as one.

    Every word of the index that lies in the text is among them; an equality join on ``part`` tells the others.  Texts
    are joined to their places by a hash: two texts of one hash only get some candidates more."""
    rows = (texts.select(*scope, text).distinct().filter(F.col(text) != "")
            .select("*", F.xxhash64(*scope, text).alias("_id"), F.split(text, "").alias("_chars")))
    n = F.size("_chars")

    def grams(size: int) -> Column:
        # single characters are read by place: cutting from the text would count from its start each time
        return F.when(n >= size, F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.struct(
            i.alias("at"), F.concat(*[F.get("_chars", i + (k - 1)) for k in range(size)]).alias("gram"))))

    every = F.concat(*[F.coalesce(grams(size), F.array()) for size in range(1, GRAM + 1)])
    placed = rows.select("_id", *scope, F.explode(every).alias("_cell")).select(
        "_id", *scope, F.col("_cell.at").alias("at"), F.col("_cell.gram").alias("_gram"))
    places = (placed.join(index, [*scope, "_gram"]).select("_id", "at", F.explode("_lens").alias("len"))
              .groupBy("_id").agg(F.collect_set(F.struct("at", "len")).alias("_places")))
    fitting = F.filter("_places", lambda p: p["at"] + p["len"] - 1 <= n)
    parts = F.array_distinct(F.transform(fitting, lambda p: F.substring(F.col(text), p["at"], p["len"])))
    return rows.join(places, "_id").select(*scope, text, F.explode(parts).alias("part"))
