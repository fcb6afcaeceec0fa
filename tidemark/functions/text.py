"""Text expressions: masking, tokens, lexicon sentiment, query expansion, topic names."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import lexicons as lx
from tidemark.functions.numbers import clip, round_half_up

# Masking patterns and their placeholders. Order matters.
# A match always covers its whole run of non-blanks, so it is only tried at the run's start.
EMAIL_PATTERN = r"(?<!\S)\S+@\S+\.\S+"
URL_PATTERN = r"https?://\S+|www\.\S+"
REFERENCE_PATTERN = r"\b(?:order|ticket|ref|case)[\s#:-]*[A-Z0-9]{4,}\b"
NUMBER_PATTERN = r"\b\d[\d,]*(?:\.\d+)?\b"
NOT_KEPT_PATTERN = r"[^a-z<>']+"  # blanks among them: a run becomes one space

# Fixed value: a word is a run of at least two letters, digits or underscores.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"

# (?U) makes \s, \d and \b follow Unicode.
_UNICODE = "(?U)"
_UNICODE_ANY_CASE = "(?Uiu)"


@F.pandas_udf(T.StringType())
def _compatibility_form(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None else unicodedata.normalize("NFKC", t))


def compatibility_form(text: Column) -> Column:
    """Unicode NFKC. ASCII text is already in that form and never leaves the JVM."""
    foreign = text.rlike(r"[^\x00-\x7F]")
    return F.coalesce(_compatibility_form(F.when(foreign, text)), text)


def normalise(text: Column, nfkc: bool = True) -> Column:
    """Mask emails, links, references and numbers; lower-case; keep letters only."""
    out = compatibility_form(text) if nfkc else text
    # Most texts have no address: theirs is the dearest pattern, tried at every character.
    out = F.when(out.contains("@"), F.regexp_replace(out, _UNICODE + EMAIL_PATTERN, " <email> ")).otherwise(out)
    out = F.regexp_replace(out, _UNICODE + URL_PATTERN, " <url> ")
    out = F.regexp_replace(out, _UNICODE_ANY_CASE + REFERENCE_PATTERN, " <ref> ")
    out = F.lower(out)
    out = F.regexp_replace(out, _UNICODE + NUMBER_PATTERN, " <num> ")
    out = F.trim(F.regexp_replace(out, NOT_KEPT_PATTERN, " "))
    return F.coalesce(out, F.lit(""))


def token_count(clean: Column) -> Column:
    return F.when(clean == "", 0).otherwise(F.size(F.split(clean, " ")))


def words(text: Column) -> Column:
    """Lower-cased words of two or more characters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def with_bigrams(tokens: Column) -> Column:
    """Tokens followed by the pairs of neighbours, joined by a space."""
    pairs = F.transform(
        F.arrays_zip(
            F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))).alias("first"),
            F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))).alias("second"),
        ),
        lambda pair: F.concat_ws(" ", pair["first"], pair["second"]),
    )
    return F.when(F.size(tokens) < 2, tokens).otherwise(F.concat(tokens, pairs))


def lexicon_sentiment(
    clean: Column,
    positive: Mapping[str, float] = lx.POSITIVE_WORDS,
    negative: Mapping[str, float] = lx.NEGATIVE_WORDS,
    negators: Sequence[str] = lx.NEGATORS,
) -> Column:
    """Signed share of lexicon weight in [-1, 1]; 0 when no lexicon word occurs.

    Ten decimals, so that texts with the same words get the same score.
    """
    weights = {w: positive.get(w, 0.0) - negative.get(w, 0.0) for w in {**positive, **negative}}
    weights = {w: v for w, v in weights.items() if v != 0.0}
    negating, reach, factor = frozenset(negators), lx.NEGATION_REACH, lx.NEGATION_FACTOR

    def balance(text: str | None) -> float:
        tokens = text.split(" ") if text is not None else []
        total = weight = 0.0
        for at in [i for i, token in enumerate(tokens) if token in weights]:
            polarity = weights[tokens[at]]
            if not negating.isdisjoint(tokens[max(at - reach, 0) : at]):
                polarity *= factor
            total += polarity
            weight += abs(polarity)
        return total / weight if weight else 0.0

    @F.arrow_udf(T.DoubleType())
    def balances(texts: pa.Array) -> pa.Array:
        return pa.array(map(balance, texts.to_pylist()), pa.float64())

    value = round_half_up(balances(clean), 10)
    return clip(value, -1.0, 1.0)


def sentiment_label(score: Column, edge: float = lx.LABEL_EDGE) -> Column:
    return F.when(score > edge, "positive").when(score < -edge, "negative").otherwise("neutral")


def expand_query(question: Column, expansions: Mapping[str, str] = lx.QUERY_EXPANSIONS) -> Column:
    """Append the synonyms of every key contained in the question, in dictionary order."""
    lowered = F.lower(question)
    found = F.array_compact(
        F.array(*[F.when(lowered.contains(key), F.lit(words)) for key, words in expansions.items()])
    )
    expanded = F.trim(F.concat_ws(" ", question, F.array_join(found, " ")))
    return F.when(F.size(found) > 0, expanded).otherwise(question)


def topic_name(terms: Column) -> Column:
    """The first three long words, one per term, that share no four-letter start."""

    def add_word(chosen: Column, term: Column) -> Column:
        fresh = F.filter(
            F.split(term, " "),
            lambda word: (F.length(word) >= 3)
            & ~F.exists(
                chosen,
                lambda c: word.startswith(F.substring(c, 1, 4)) | c.startswith(F.substring(word, 1, 4)),
            ),
        )
        full = F.size(chosen) >= 3
        return F.when(full | (F.size(fresh) == 0), chosen).otherwise(
            F.concat(chosen, F.slice(fresh, 1, 1))
        )

    picked = F.aggregate(terms, F.array().cast("array<string>"), add_word)
    return F.when(F.size(picked) == 0, "misc").otherwise(F.array_join(picked, " · "))


def driver_direction(contribution: Column) -> Column:
    return F.when(contribution > 0, lx.RAISES_RISK).otherwise(lx.LOWERS_RISK)


def driver_reason(feature: Column, contribution: Column) -> Column:
    """Plain-English reason; unknown inputs fall back to their base name and level."""
    phrases = _lookup({name: texts[0] for name, texts in lx.DRIVER_NARRATIVES.items()})
    base, level = _base_and_level(feature)
    base_phrase = F.try_element_at(phrases, base)
    raised = F.when(contribution > 0, "elevated").otherwise("low")
    return F.coalesce(
        F.try_element_at(phrases, feature),
        F.when(
            feature.contains("_"),
            F.coalesce(
                F.concat(base_phrase, F.lit(" ("), level, F.lit(")")),
                F.concat(base, F.lit(" = "), level),
            ),
        ),
        F.concat_ws(" ", raised, feature),
    )


def driver_action(feature: Column, contribution: Column) -> Column:
    actions = _lookup({name: texts[1] for name, texts in lx.DRIVER_NARRATIVES.items()})
    base, _ = _base_and_level(feature)
    known = F.coalesce(
        F.try_element_at(actions, feature),
        F.when(feature.contains("_"), F.try_element_at(actions, base)),
        F.lit(lx.DEFAULT_DRIVER_ACTION),
    )
    return F.when(contribution > 0, known).otherwise(lx.NO_DRIVER_ACTION)


def _base_and_level(feature: Column) -> tuple[Column, Column]:
    base = F.substring_index(feature, "_", 1)
    return base, F.substr(feature, F.length(base) + 2)


def _lookup(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for item in mapping.items() for x in item])
