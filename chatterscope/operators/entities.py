"""Dictionary entities: phrases of a gazetteer found in title and body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chatterscope.constants import ENTITY_TYPES, STOP_ENTITIES, TOP_ENTITIES
from chatterscope.functions.arrays import settled, unnest_structs
from chatterscope.functions.text import ENTITY_TOKEN, ENTITY_WORD, post_text, strip, title_case
from chatterscope.operators.broadcasts import small
from chatterscope.operators.toplists import top_n_per_group


def clean_entity(text: Column) -> Column:
    return title_case(strip(text))


def is_reportable(cleaned: Column) -> Column:
    """False for single letters, stop entities, and text without any letter."""
    return (
        (F.length(cleaned) >= 2)
        & ~F.lower(cleaned).isin(STOP_ENTITIES)
        & ~cleaned.rlike(r"(?U)^[\d\s\W]+$")
    )


def entity_cleanup(df: DataFrame, column: str) -> DataFrame:
    """Cleans a column of entity texts and drops the rows that are not reportable."""
    return df.withColumn(column, clean_entity(F.col(column))).where(is_reportable(F.col(column)))


def _phrases(gazetteer: DataFrame) -> DataFrame:
    """Gazetteer rows ready to join: first word, normal spelling, length and clean text.

    Cleaning depends on the phrase alone, so it is done here and not per mention.
    """
    words = gazetteer.where(F.col("entity_type").isin(ENTITY_TYPES)).select(
        "phrase", "entity_type", F.regexp_extract_all("phrase", F.lit(ENTITY_WORD), F.lit(0)).alias("_g")
    )
    return words.where(F.size("_g") > 0).select(
        F.get(F.col("_g"), F.lit(0)).alias("_first"),
        F.array_join("_g", " ").alias("_phrase"),
        F.size("_g").alias("_length"),
        clean_entity(F.col("phrase")).alias("entity_text"),
        "entity_type",
    ).distinct()


#: The most bits of a level of the trie; a gazetteer of more phrases passes more words on to the join.
TRIE_BITS = 1 << 17


def _slot(bits: int, *words: Column) -> Column:
    """Spark hashes words one by one as it hashes an array of them."""
    return F.pmod(F.xxhash64(*words), F.lit(bits))


class _Trie:
    """The prefixes of all phrases, by the hash of their first 1, 2, 4... words, one bit set per length.

    A bit that two prefixes share lets a word pass that begins no phrase; the join after it is exact.
    """

    def __init__(self, phrases: DataFrame, longest: int, count: int):
        self.longest = max(1, longest)
        lengths = [1 << k for k in range(self.longest.bit_length())]
        bits = min(1024, TRIE_BITS)
        while bits < TRIE_BITS and bits < 16 * count:
            bits *= 2
        words = phrases.select(F.split("_phrase", " ").alias("_w"))
        prefixes = F.array(*[
            F.when(F.size("_w") >= n, F.struct(F.lit(n).alias("n"), _slot(bits, F.slice("_w", 1, n)).alias("slot")))
            for n in lengths
        ])
        lanes = {n: [0] * (bits // 64) for n in lengths}
        for n, slot in words.select(F.inline(F.array_compact(prefixes))).distinct().collect():  # at most TRIE_BITS of a length
            lanes[n][slot // 64] |= 1 << slot % 64
        signed = {n: [x - (1 << 64) if x >> 63 else x for x in own] for n, own in lanes.items()}
        self.levels = [(n, bits, F.array(*[F.lit(x).cast("long") for x in signed[n]])) for n in lengths]

    def reach(self, words: str, word: Column, i: Column) -> Column:
        """How many words from ``word`` at place ``i`` on a phrase can have: walks down while the prefix exists."""
        out = F.lit(self.longest)
        for length, bits, lanes in reversed(self.levels):
            own = [word] if length == 1 else [F.slice(words, i + 1, length)]
            slot = _slot(bits, *own).cast("int")
            bit = F.call_function("shiftright", F.get(lanes, F.shiftright(slot, 6)), slot % 64).bitwiseAND(F.lit(1).cast("long"))
            out = F.when(bit == 1, out).otherwise(F.lit(length - 1))
        return out


def _begun(texts: DataFrame, phrases: DataFrame, longest: int, count: int) -> DataFrame:
    """(post_id, _which, start, _next): the words that may begin a phrase and what follows them, no longer than the trie reaches there."""
    trie = _Trie(phrases, longest, count)
    text = F.coalesce("_text", F.lit(""))
    tokens = texts.select(
        "post_id", F.struct(F.xxhash64(text), F.xxhash64(F.lit(1), text)).alias("_which"),
        text.alias("_text"),
    )
    words = settled(tokens, "_words", F.regexp_extract_all("_text", F.lit(ENTITY_TOKEN), F.lit(0))).drop("_text")
    reached = settled(words, "_reach", F.transform("_words", lambda w, i: trie.reach("_words", w, i)))
    starts = F.array_compact(F.transform("_reach", lambda n, i: F.when(n > 0, i)))
    spans = F.transform(
        "_starts",
        lambda i: F.struct(i.alias("start"), F.slice("_words", i + 1, F.get(F.col("_reach"), i)).alias("_next")),
    )
    return unnest_structs(settled(reached, "_starts", starts), ["post_id", "_which"], spans)


def mentions(texts: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """All longest phrase matches in ``(post_id, _text)`` rows, with their word positions.

    Only words that begin some phrase become rows, with as many words after them as the trie allows, and the spans of every
    phrase length that occurs meet the gazetteer whole, so a common first word is no join key. Ends of sentences and
    lines are tokens of their own, which no phrase has. Rows that repeat a post and its text count once.
    """
    phrases = _phrases(gazetteer)
    sizes = dict(phrases.groupBy("_length").count().collect())
    lengths, longest = sorted(sizes), max(sizes, default=1)
    begun = _begun(texts, phrases, longest, sum(sizes.values()))
    spans = begun.withColumn("_length", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>"))).where(
        F.size("_next") >= F.col("_length")
    )
    found = spans.withColumn("_phrase", F.array_join(F.slice("_next", 1, F.col("_length")), " ")).join(
        small(phrases.drop("_first"), gazetteer), ["_length", "_phrase"]
    ).select(
        "post_id", "_which", "start", (F.col("start") + F.col("_length")).alias("end"),
        "entity_text", "entity_type",
    ).distinct()
    # A match is dropped if a longer one covers it.
    by_start = Window.partitionBy("post_id", "_which").orderBy("start")
    earlier = F.max("end").over(by_start.rangeBetween(-max(1, longest - 1), -1))
    same = F.max("end").over(by_start.rangeBetween(0, 0))
    return (
        found.withColumn("_earlier", earlier)
        .withColumn("_same", same)
        .where((F.coalesce("_earlier", F.lit(0)) < F.col("end")) & (F.col("_same") == F.col("end")))
        .drop("_earlier", "_same", "_which")
    )


def entity_counts(found: DataFrame) -> DataFrame:
    """Mentions per post, entity and type."""
    return found.groupBy("post_id", "entity_text", "entity_type").agg(
        F.count(F.lit(1)).alias("mention_count")
    )


def gazetteer_entities(texts: DataFrame, gazetteer: DataFrame, top_n: int = TOP_ENTITIES) -> DataFrame:
    """The ``top_n`` most mentioned reportable entities of each post, over all its texts."""
    found = mentions(texts, gazetteer).where(is_reportable(F.col("entity_text")))
    return top_n_per_group(
        entity_counts(found), ["post_id"],
        [F.desc("mention_count"), F.col("entity_text"), F.col("entity_type")], top_n,
    ).drop("rank")


def extract_from_posts(
    posts: DataFrame, gazetteer: DataFrame, top_n: int = TOP_ENTITIES
) -> DataFrame:
    """Entities of title and body of each post."""
    texts = posts.select("post_id", post_text(F.col("title"), F.col("body")).alias("_text"))
    return gazetteer_entities(texts, gazetteer, top_n)
