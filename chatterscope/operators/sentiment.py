"""Lexicon sentiment with context rules, after Hutto and Gilbert (ICWSM 2014).

A mark by the hash of each lexicon term tells which words may be rated. These and the first word become rows, each with its
three predecessors, and meet lexicon and modifiers. Idioms are found from there in the words of the text: a phrase that begins within another one
gives way, its valence stands at its first word, and its other words are plain ones. Emoji are read as their names.
Sums are kept as integers, so scores do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from chatterscope.functions.arrays import settled, unnest_structs
from chatterscope.functions.numbers import round_half_up, sentiment_label
from chatterscope.functions.text import (
    PUNCTUATION, count_char, is_blank, is_shouted, sentiment_text, strip,
)
from chatterscope.operators.broadcasts import small

# Published constants of the method.
CAPS = 0.733
NEGATION = -0.74
DAMPING = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MAX_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
ALPHA = 15.0
#: "least" turns the word after it, but not after these.
NOT_LEAST = ("at", "very")
#: Idioms and emoji are part of the plan; more than this are refused.
MAX_IDIOMS, MAX_EMOJI = 1_000, 5_000

_SCALE = 1_000_000


def _units(value: Column) -> Column:
    return F.round(value * float(_SCALE)).cast("long")


def _bare(word: Column) -> Column:
    """A word without outer punctuation; up to two letters keep theirs."""
    inner = F.btrim(word, F.lit(PUNCTUATION))
    return F.when(F.length(inner) > 2, inner).otherwise(word)


def _low(word: Column) -> Column:
    return F.lower(_bare(word))


def _emphasis(text: Column) -> Column:
    """What exclamation and question marks add to the strength of a text."""
    shouts = F.least(count_char(text, "!"), F.lit(MAX_EXCLAMATIONS)) * EXCLAMATION
    asks = count_char(text, "?")
    doubts = (
        F.when(asks <= 1, F.lit(0.0))
        .when(asks <= MAX_QUESTIONS, asks * QUESTION)
        .otherwise(F.lit(MANY_QUESTIONS))
    )
    return shouts + doubts


def _listed(table: DataFrame, key: str, value: str, most: int) -> dict:
    """A small table as a dictionary, the largest value of a key; rows with nulls are left out."""
    found = table.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.max(value)).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} rows of {key}")
    return dict(map(tuple, found))


def spell_emoji(text: Column, names: dict[str, str]) -> Column:
    """The text with the name of each emoji, between blanks, in its place. The longest of emoji that begin alike is read."""
    if not names:
        return text
    quoted = [rf"\Q{s}\E" for s in sorted(names, key=lambda s: (-len(s), s))]
    symbol = "(?:" + "|".join(quoted) + r")\x{FE0F}?"
    # A class of first characters is much quicker to search for than the symbols.
    begun = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in sorted({s[0] for s in names if s})) + "]"
    spelled = F.create_map(*[F.lit(x) for s, n in sorted(names.items()) for x in (s, f" {n} ")])
    between = F.split(text, symbol, -1)
    found = F.regexp_extract_all(text, F.lit(f"({symbol})"), F.lit(1))
    bare = lambda s: F.coalesce(F.try_element_at(spelled, s), F.try_element_at(spelled, F.rtrim(s, F.lit("\ufe0f"))))
    joined = F.zip_with(between, F.transform(found, bare), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(text.rlike(begun) & text.rlike(symbol), F.array_join(joined, "")).otherwise(text)


def _by_length(idioms: dict[str, float]) -> dict[int, dict[str, float]]:
    """Valences of lower-case phrases, by their number of words."""
    phrases: dict[int, dict[str, float]] = {}
    for term, valence in idioms.items():
        words = term.lower().split()
        if words:
            own, name = phrases.setdefault(len(words), {}), " ".join(words)
            own[name] = max(valence, own.get(name, valence))
    return phrases


def _found_idioms(phrases: dict[int, dict[str, float]]) -> Column:
    """The longest idiom that begins at each of _places, where there is one: (place i, n words, valence v)."""
    firsts = sorted({name.split(" ")[0] for own in phrases.values() for name in own})

    def at(i: Column) -> Column:
        choices = []
        for n in sorted(phrases, reverse=True):
            rated = F.create_map(*[F.lit(x) for item in sorted(phrases[n].items()) for x in item])
            value = F.try_element_at(rated, F.array_join(F.transform(F.slice("_words", i + 1, n), _low), " "))
            choices.append(F.when(value.isNotNull(), F.struct(i.alias("i"), F.lit(n).alias("n"), value.alias("v"))))
        return F.when(_low(F.get(F.col("_words"), i)).isin(firsts), F.coalesce(*choices))

    return F.array_compact(F.transform("_places", at))


def _idiom_fields(i: Column) -> list[Column]:
    """At a place: the valence of the idiom that begins there, and whether an earlier one covers it."""
    covered = F.exists("_idioms", lambda x: (x["i"] < i) & (x["i"] + x["n"] > i))
    own = F.get(F.filter("_idioms", lambda x: x["i"] == i), F.lit(0))
    return [F.when(~covered, own["v"]).alias("iv"), covered.alias("inside")]


#: The most places of the mark of rated words; a longer lexicon passes more words on to the join.
MARK_SLOTS = 1 << 17


def _marked(terms: DataFrame) -> Callable[[Column], Column]:
    """Whether a word may be one of the terms, by a byte for the hash of each. Two words may share one; what follows is exact."""
    words = terms.select("term")
    count, slots = words.count(), 1024
    while slots < MARK_SLOTS and slots < 16 * count:
        slots *= 2
    slot = lambda word: F.pmod(F.xxhash64(word), F.lit(slots)).cast("int")
    mark = bytearray(slots)
    for (at,) in words.where("term is not null").select(slot(F.col("term"))).distinct().collect():  # at most MARK_SLOTS
        mark[at] = 1
    # Cut out of a literal, as that works out the word once.
    return lambda word: F.substring(F.lit(bytes(mark)), slot(word) + 1, 1) == F.lit(b"\x01")


def _word_rows(texts: DataFrame, keep: list[str], rated: DataFrame, idioms: dict[str, float]) -> DataFrame:
    """Rows of the first word and of those that may be rated, by the terms of ``rated`` or as the beginning of an idiom.

    Each has its position, predecessors and the facts of its post, and what idioms say of it if there are any.
    """
    phrases = _by_length(idioms)
    firsts = sorted({name.split(" ")[0] for own in phrases.values() for name in own})
    terms = rated.select("term")
    marked = _marked(terms.unionByName(rated.sparkSession.createDataFrame([(w,) for w in firsts], "term string")) if firsts else terms)
    text = F.coalesce("_text", F.lit(""))
    split = texts.select(
        *keep,
        F.struct(F.xxhash64("_text"), F.xxhash64(F.lit(1), "_text")).alias("_which"),
        is_blank(F.col("_text")).alias("_blank"),
        _units(_emphasis(text)).alias("_emphasis"),
        F.contains(F.lower(text), F.lit("but")).alias("_maybe"),
        F.split(strip(text), r"\s+").alias("_split"),
    )
    tokens = settled(split, "_words", F.col("_split")).drop("_split")
    but = F.array_position(F.transform("_words", _low), "but") - 1
    facts = tokens.select(
        *keep, "_which", "_blank", "_emphasis", "_words",
        F.size("_words").alias("_count"),
        # Outer punctuation has no case.
        (F.exists("_words", is_shouted) & ~F.forall("_words", is_shouted)).alias("_mixed"),
        F.when(F.col("_maybe"), but).otherwise(F.lit(-1)).alias("_but"),
    )
    facts_of = [*keep, "_which", "_blank", "_emphasis", "_count", "_mixed", "_but"]
    if not phrases:
        rows = facts.select(*facts_of, "_words", F.posexplode("_words").alias("i", "_word"))
        rows = rows.where((F.col("i") == 0) | marked(_low(F.col("_word"))))
        before = [_bare(F.get(F.col("_words"), F.col("i") - k)).alias(f"p{k}") for k in (1, 2, 3)]
        return rows.select(*facts_of, "i", _bare(F.col("_word")).alias("w"), *before).withColumnRenamed("_count", "_words")
    # Where idioms can be, the words stay in the row until all of a text are known.
    word = lambda i: F.get(F.col("_words"), i)
    every = F.sequence(F.lit(0), F.size("_words") - 1)
    placed = settled(facts, "_places", F.filter(every, lambda i: (i == 0) | marked(_low(word(i)))))
    rows = F.transform("_places", lambda i: F.struct(
        i.alias("i"), _bare(word(i)).alias("w"), *[_bare(word(i - k)).alias(f"p{k}") for k in (1, 2, 3)], *_idiom_fields(i),
    ))
    return unnest_structs(settled(placed, "_idioms", _found_idioms(phrases)), facts_of, rows).withColumnRenamed("_count", "_words")


def _apply_predecessor(rows: DataFrame, modifiers: DataFrame, k: int) -> DataFrame:
    """Lets the word ``k`` places before strengthen, weaken or negate the valence."""
    previous = F.when(F.col("valence").isNotNull(), F.lower(F.col(f"p{k}")))
    found = rows.join(
        modifiers.select(
            F.col("term").alias("_mterm"), F.col("kind").alias("_kind"), F.col("weight").alias("_weight")
        ),
        previous == F.col("_mterm"),
        "left",
    )
    v = F.col("valence")
    boost = F.when(
        F.col("_kind") == "booster",
        (
            F.signum(v) * F.col("_weight")
            + F.when(F.col("_mixed") & is_shouted(F.col(f"p{k}")), F.signum(v) * CAPS).otherwise(0.0)
        )
        * DAMPING[k - 1],
    ).otherwise(0.0)
    negated = F.coalesce(
        (F.col("_kind") == "negator") | previous.contains("n't"), F.lit(False)
    )
    turn = F.when(negated, F.lit(NEGATION)).otherwise(F.lit(1.0))
    found = found.withColumn("valence", (v + boost) * turn)
    if k == 1:
        exempt = F.coalesce(F.lower("p2").isin(*NOT_LEAST), F.lit(False))
        found = found.withColumn("_least", F.coalesce(F.col("_kind") == "least", F.lit(False)) & ~exempt)
    return found.drop("_mterm", "_kind", "_weight")


def score_texts(
    texts: DataFrame,
    lexicon: DataFrame,
    modifiers: DataFrame,
    blank_neutral: float = 1.0,
    carry: tuple[str, ...] = (),
    idioms: DataFrame | None = None,
    emoji: DataFrame | None = None,
) -> DataFrame:
    """Scores ``(post_id, _text)`` rows; one result per post and text.

    ``idioms`` (term, valence) are phrases of one word or more whose valence replaces that of their words; ``emoji``
    (symbol, name) are read as their names. A modifier of kind "least" turns the word after it, unless "at" or "very" comes before.

    Rows that repeat a post and its text are scored once, and two texts under one key apart.
    ``blank_neutral`` is the neutral share of a text without words. ``carry`` names further
    columns of the post to hand on.
    """
    keep = ["post_id", *carry]
    # "but" only sets the turning point. A booster is never rated itself, and a rated word
    # never acts as a negator.
    boosters = modifiers.where("kind = 'booster'")
    negators = modifiers.where("kind = 'negator'")
    rated = lexicon.join(boosters.select("term"), "term", "left_anti")
    turning = negators.unionByName(modifiers.where("kind = 'least'"))
    acting = boosters.unionByName(turning.join(lexicon.select("term"), "term", "left_anti"))
    rated, acting = small(rated, lexicon), small(acting, modifiers)

    if emoji is not None:
        texts = texts.withColumn("_text", spell_emoji(F.col("_text"), _listed(emoji, "symbol", "name", MAX_EMOJI)))
    phrases = {} if idioms is None else _listed(idioms, "term", "valence", MAX_IDIOMS)
    rows = _word_rows(texts, keep, lexicon, phrases).join(
        rated.select(F.col("term").alias("_term"), "valence"),
        F.lower(F.col("w")) == F.col("_term"),
        "left",
    )
    if "iv" in rows.columns:
        rows = rows.withColumn("valence", F.when(~F.col("inside"), F.coalesce("iv", "valence"))).drop("iv", "inside")
    rows = rows.where(F.col("valence").isNotNull() | (F.col("i") == 0)).drop("_term")

    v = F.col("valence")
    rows = rows.withColumn(
        "valence",
        v + F.when(F.col("_mixed") & is_shouted(F.col("w")), F.signum(v) * CAPS).otherwise(0.0),
    )
    for k in (1, 2, 3):
        rows = _apply_predecessor(rows, acting, k)
    rows = rows.withColumn("valence", F.when(F.col("_least"), F.col("valence") * NEGATION).otherwise(F.col("valence")))
    weight = (
        F.when((F.col("_but") < 0) | (F.col("i") == F.col("_but")), F.lit(1.0))
        .when(F.col("i") < F.col("_but"), F.lit(BEFORE_BUT))
        .otherwise(F.lit(AFTER_BUT))
    )
    rows = rows.withColumn("_v", _units(F.col("valence") * weight))

    hit = F.col("_v")
    sums = rows.groupBy(*keep, "_which", "_blank", "_emphasis", "_words").agg(
        F.coalesce(F.sum(hit), F.lit(0)).alias("_sum"),
        F.coalesce(F.sum(F.when(hit > 0, hit + _SCALE)), F.lit(0)).alias("_pos"),
        F.coalesce(F.sum(F.when(hit < 0, _SCALE - hit)), F.lit(0)).alias("_neg"),
        F.count_if(hit != 0).alias("_hits"),
        F.count_if(F.col("i") == 0).alias("_copies"),
    )
    # Each copy of a row added the same, so these divisions leave no rest.
    once = {c: F.expr(f"{c} div _copies") for c in ("_sum", "_pos", "_neg", "_hits")}
    return _finish(sums.withColumns(once), keep, blank_neutral)


def _finish(sums: DataFrame, keep: list[str], blank_neutral: float) -> DataFrame:
    """From sums to compound score, shares and label."""
    emphasis, pos, neg = F.col("_emphasis"), F.col("_pos"), F.col("_neg")
    sums = sums.select(
        *keep, "_blank",
        ((F.col("_sum") + F.signum("_sum").cast("long") * emphasis) / float(_SCALE)).alias("_s"),
        (pos + F.when(pos > neg, emphasis).otherwise(0)).alias("_pos"),
        (neg + F.when(neg > pos, emphasis).otherwise(0)).alias("_neg"),
        ((F.col("_words") - F.col("_hits")) * _SCALE).alias("_neu"),
    )
    total = (F.col("_pos") + F.col("_neg") + F.col("_neu")).cast("double")

    def share(name):
        return round_half_up(F.col(name) / total, 3)

    def unless_blank(value, blank):
        return F.when(F.col("_blank"), F.lit(blank)).otherwise(value)

    compound = round_half_up(F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + ALPHA), 4)
    return sums.select(
        *keep,
        unless_blank(compound, 0.0).alias("compound"),
        unless_blank(share("_pos"), 0.0).alias("positive"),
        unless_blank(share("_neg"), 0.0).alias("negative"),
        unless_blank(share("_neu"), blank_neutral).alias("neutral"),
    ).withColumn("label", sentiment_label(F.col("compound")))


def lexicon_sentiment(
    posts: DataFrame,
    lexicon: DataFrame,
    modifiers: DataFrame,
    carry: tuple[str, ...] = (),
    idioms: DataFrame | None = None,
    emoji: DataFrame | None = None,
) -> DataFrame:
    """Sentiment of title and body of each post."""
    texts = posts.select(
        "post_id", *carry, sentiment_text(F.col("title"), F.col("body")).alias("_text")
    )
    return score_texts(texts, lexicon, modifiers, carry=carry, idioms=idioms, emoji=emoji)


def title_sentiment(
    posts: DataFrame,
    lexicon: DataFrame,
    modifiers: DataFrame,
    carry: tuple[str, ...] = (),
    idioms: DataFrame | None = None,
    emoji: DataFrame | None = None,
) -> DataFrame:
    """Sentiment of the title alone, as used for feeds; an empty title scores zero throughout."""
    texts = posts.select("post_id", *carry, F.col("title").alias("_text"))
    return score_texts(texts, lexicon, modifiers, blank_neutral=0.0, carry=carry, idioms=idioms, emoji=emoji)


def nested(scores: DataFrame) -> DataFrame:
    """Scores as one struct next to the key."""
    return scores.select(
        "post_id", F.struct("compound", "positive", "negative", "neutral", "label").alias("sentiment")
    )


def flatten_sentiment(scored: DataFrame) -> DataFrame:
    return scored.select("post_id", "sentiment.*")
