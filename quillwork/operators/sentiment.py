"""Lexicon sentiment and term counts (AGG7, AGG8, JON3, SEN1)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def term_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """AGG7: term and its count over all rows."""
    return df.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def term_counts_by(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """AGG7 per row key."""
    return df.select(key, F.explode(tokens).alias("term")).groupBy(key, "term").agg(F.count("*").alias("n"))


def proportions(df: DataFrame, key: str, tokens: Column, positive: list[str], negative: list[str]) -> DataFrame:
    """AGG8, JON3 for short lexicons: shares of positive, negative and neutral tokens; a word of both is positive; no tokens give null."""
    d = df.select(key, tokens.alias("_t"))
    n, pos = F.size("_t"), F.size(F.filter("_t", lambda t: t.isin(*positive)))
    neg = F.size(F.filter("_t", lambda t: t.isin(*negative) & ~t.isin(*positive)))
    return d.select(key, *[F.try_divide(x.cast("double"), n.cast("double")).alias(name) for x, name in ((pos, "positive"), (neg, "negative"), (n - pos - neg, "neutral"))])


def proportions_by_join(df: DataFrame, key: str, tokens: Column, lexicon: DataFrame) -> DataFrame:
    """AGG8, JON3 for a lexicon table (word, polarity 1 or -1): the planner broadcasts it under its size threshold. A word of both is positive."""
    words = lexicon.groupBy("word").agg(F.max("polarity").alias("polarity"))
    long = df.select(key, F.explode_outer(tokens).alias("word")).join(words, "word", "left")
    n = F.count("word")
    share = lambda c: F.try_divide(F.count_if(c & F.col("word").isNotNull()).cast("double"), n.cast("double"))
    return long.groupBy(key).agg(share(F.col("polarity") == 1).alias("positive"), share(F.col("polarity") == -1).alias("negative"), share(F.col("polarity").isNull()).alias("neutral"))


#: Published constants of the valence rules (Hutto and Gilbert, 2014): words that strengthen or weaken the next one, negations, and the amounts (fixed values).
BOOST_UP = "absolutely amazingly awfully completely considerably decidedly deeply enormously entirely especially exceptionally extremely fabulously fully greatly highly hugely incredibly intensely majorly more most particularly purely quite really remarkably so substantially thoroughly totally tremendously uber unbelievably unusually utterly very".split()
BOOST_DOWN = "almost barely hardly kinda less little marginally occasionally partly scarcely slightly somewhat sorta".split()
NEGATIONS = "aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neither never none nope nor not nothing nowhere oughtnt rarely seldom shant shouldnt wasnt werent without wont wouldnt despite".split()
BOOST, CAPITALS, NEGATED, BUT_BEFORE, BUT_AFTER, BANG, QUESTION, QUESTIONS, ALPHA = 0.293, 0.733, -0.74, 0.5, 1.5, 0.292, 0.18, 0.96, 15.0
FADE = (1.0, 0.95, 0.9)
PHRASES_DOWN = {("kind", "of"), ("sort", "of")}


class Valence:
    """Scores of one text by valence rules."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.boost = dict.fromkeys(BOOST_UP, BOOST) | dict.fromkeys(BOOST_DOWN, -BOOST)

    @staticmethod
    def _denies(word: str) -> bool:
        return word.replace("'", "") in NEGATIONS or "n't" in word

    def _word(self, low: list[str], shout: list[bool], i: int) -> float:
        """The valence of word i by its neighbours."""
        v = self.lexicon.get(low[i], 0.0)
        if not v or low[i] in self.boost:
            return 0.0
        sign = 1.0 if v > 0 else -1.0
        v += sign * CAPITALS * shout[i]
        for back, fade in enumerate(FADE, 1):
            j = i - back
            if j < 0 or low[j] in self.lexicon:
                continue
            push = self.boost.get(low[j], 0.0)
            if push:
                v += sign * (push + CAPITALS * shout[j]) * fade
            v = self._flipped(low, i, back, v)
        if tuple(low[max(0, i - 2) : i]) in PHRASES_DOWN:
            v -= sign * BOOST
        if i > 0 and low[i - 1] == "least" and (i < 2 or low[i - 2] not in ("at", "very")):
            v *= NEGATED
        return v

    def _flipped(self, low: list[str], i: int, back: int, v: float) -> float:
        """v behind a negation `back` words before; `never so`, `never this` strengthen, `without doubt` leaves."""
        word = low[i - back]
        if back > 1 and word == "never" and {"so", "this"} & set(low[i - back + 1 : i]):
            return v * (1.5 if back == 2 else 1.25)
        if back > 1 and word == "without" and "doubt" in low[i - back + 1 : i]:
            return v
        return v * NEGATED if self._denies(word) else v

    def score(self, text: str | None) -> tuple[float, float, float, float]:
        """neg, neu, pos and compound; without words all 0."""
        marks = ".,;:!?\"'()[]{}*#%&$<>|~`^-_=+/\\@"
        words = [w if len(w.strip(marks)) <= 2 else w.strip(marks) for w in (text or "").split()]
        if not words:
            return 0.0, 0.0, 0.0, 0.0
        low, up = [w.lower() for w in words], [w.isupper() for w in words]
        mixed = 0 < sum(up) < len(up)
        shout = [u and mixed for u in up]
        got = [0.0 if low[i : i + 2] == ["kind", "of"] else self._word(low, shout, i) for i in range(len(low))]
        if "but" in low:
            at = low.index("but")
            got = [v * (BUT_BEFORE if i < at else BUT_AFTER if i > at else 1.0) for i, v in enumerate(got)]
        asked = text.count("?")
        stress = min(text.count("!"), 4) * BANG + (0.0 if asked < 2 else QUESTION * asked if asked <= 3 else QUESTIONS)
        total = sum(got)
        if total:
            total += stress if total > 0 else -stress
        compound = max(-1.0, min(1.0, total / (total * total + ALPHA) ** 0.5))
        pos, neg, neu = sum(v + 1 for v in got if v > 0), sum(1 - v for v in got if v < 0), sum(v == 0 for v in got)
        if pos > neg:
            pos += stress
        elif neg > pos:
            neg += stress
        whole = pos + neg + neu
        return neg / whole, neu / whole, pos / whole, compound


def polarity(df: DataFrame, text: str, valence: dict[str, float]) -> DataFrame:
    """SEN1: df with neg, neu, pos and compound by word valences and the published rules: boosters fade over three words, negations flip, `but` shifts
    the weight, capitals and marks stress. Each distinct text of an Arrow batch is scored once."""
    rules = Valence(valence)

    @F.pandas_udf("struct<neg: double, neu: double, pos: double, compound: double>")
    def score(texts: pd.Series) -> pd.DataFrame:
        codes, distinct = pd.factorize(texts, use_na_sentinel=False)
        rows = pd.DataFrame([rules.score(t if isinstance(t, str) else None) for t in distinct], columns=["neg", "neu", "pos", "compound"], dtype=float)
        return rows.take(codes).reset_index(drop=True)

    names = ("neg", "neu", "pos", "compound")
    return df.drop(*names).withColumn("_score", score(F.col(text))).select(*[c for c in df.columns if c not in names], "_score.*")
