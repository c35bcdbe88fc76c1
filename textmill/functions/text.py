"""Text functions: HTML blocks, accents, tokens, lemmas, punctuation.

All patterns use the syntax shared by Java and RE2 (no look-around, no back-references), so the same expression can be
checked against an independent SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import lexicon
from textmill.functions.literals import replace_all, sql_literal
from textmill.functions.numeric import bind_once

# Token and text patterns.
SPACE_SPLIT = r"\s+"
WORD_TOKEN = r"\b\w\w+\b"
PUNCT_TOKEN = r"\w+|[^\w\s]"
ENTITY_TOKEN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
    r"|(?:https?://|www\.)[^\s<>]+"
    r"|[0-9]+(?:[.,/][0-9]+)*\b"
    r"|[\p{L}\p{N}_]+"
    r"|[^\p{L}\p{N}_\s]"
)
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
URL = r"^(?:https?://|www\.)"
NUMBER = r"^[+~-]?[0-9]+(?:[.,/][0-9]+)*$"
ADDRESS = r"\b[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}|\b(?:https?://|www\.)[^\s<>]+"
ADDRESS_HINT = r"@|://|www\."
NON_WORD = r"[^\p{L}\p{N}_]+"
NO_LETTER = r"^(?:[0-9]+|_+)$"
PUNCT_ONLY = r"^[^\p{L}\p{N}]+$"
INVISIBLE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
ANY_TAG = r"<[A-Za-z/!][^>]*>"


# ---- HTML -----------------------------------------------------------------------------------------------------------


def strip_invisible(html: Column) -> Column:
    """Drop scripts, styles and comments; null becomes the empty string."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), INVISIBLE, "")


def decode_references(text: Column) -> Column:
    """``&#233;`` and ``&#xE9;`` to characters; ``&#38;`` becomes ``&amp;``, which is decoded last. Codes without a character stay."""

    def one(part: Column) -> Column:
        digits = F.regexp_extract(part, "^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
        code = F.when(digits.rlike("^[xX]"), F.conv(F.substring(digits, 2, 6), 16, 10)).otherwise(digits).try_cast("int")
        known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(code == 38, F.lit("&amp;")).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.when(known, F.concat(char, F.substr(part, F.length(digits) + 2))).otherwise(F.concat(F.lit("&#"), part))

    parts = F.split(text, "&#")
    return F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), one), ""))


def decode_entities(text: Column) -> Column:
    """Named entities and character codes to characters, after tags are gone, so that ``&lt;p>`` stays text."""
    coded = bind_once(text, lambda t: F.when(t.rlike("&#[0-9xX]"), decode_references(t)).otherwise(t))
    return bind_once(
        coded, lambda t: F.when(F.contains(t, F.lit("&")), replace_all(t, lexicon.HTML_ENTITIES.items())).otherwise(t)
    )


def block_texts(html: Column, tag: str) -> Column:
    """Text of every ``<tag>`` block as an array. A block ends at its close tag or at the next opener of the same tag."""
    closed = F.concat(
        F.regexp_replace(strip_invisible(html), rf"(?i)<{tag}(\s[^>]*)?>", f"</{tag}><{tag}>"), F.lit(f"</{tag}>")
    )
    blocks = F.regexp_extract_all(closed, F.lit(rf"(?is)<{tag}>(.*?)</{tag}>"), F.lit(1))
    return F.transform(blocks, lambda b: F.regexp_replace(b, ANY_TAG, " "))


def block_text(html: Column, tag: str) -> Column:
    """All blocks of one tag as one string, inline tags as spaces, entities decoded."""
    return decode_entities(F.array_join(block_texts(html, tag), " "))


def extract_blocks(df: DataFrame, html: str, tags: Sequence[str] = ("p", "code")) -> DataFrame:
    """Add one ``<tag>_text`` column per tag name."""
    return df.withColumns({f"{t}_text": block_text(F.col(html), t) for t in tags})


def html_text(html: Column) -> Column:
    """All visible text of a document, whitespace runs collapsed."""
    bare = decode_entities(F.regexp_replace(strip_invisible(html), ANY_TAG, " "))
    return F.trim(F.regexp_replace(bare, SPACE_SPLIT, " "))


# ---- letters and punctuation ----------------------------------------------------------------------------------------


def fold_accents(text: Column) -> Column:
    """Latin letters and common typographic marks to ASCII; null becomes the empty string.

    A text with as many bytes as characters is plain ASCII and is passed through untouched.
    """
    source, target, multi = lexicon.accent_tables()
    folded = F.translate(text, source, target)
    # the multi-letter replacements only run for the few texts that still hold such a letter
    grown = replace_all(folded, sorted(multi.items()))
    return (
        F.when(text.isNull(), F.lit(""))
        .when(F.octet_length(text) == F.char_length(text), text)
        .when(text.rlike("[" + "".join(sorted(multi)) + r"\p{Mn}]"), F.regexp_replace(grown, r"\p{Mn}", ""))
        .otherwise(folded)
    )


def strip_punct(text: Column) -> Column:
    """Punctuation runs to a space, then only tokens longer than one character that are not all digits."""
    words = F.split(F.regexp_replace(text, r"[\p{Punct}\s]+", " "), " ")
    kept = F.filter(words, lambda w: (F.length(w) > 1) & ~w.rlike(r"^\p{Nd}+$"))
    return F.array_join(kept, " ")


# ---- tokens ---------------------------------------------------------------------------------------------------------


def tokenise(text: Column, how: str | Callable[[Column], Column] = "space") -> Column:
    """Token array. ``how`` is 'space', 'words', 'punct', 'entities' or any Column -> Column callable."""
    if callable(how):
        return how(text)
    if how == "space":
        return F.filter(F.split(text, SPACE_SPLIT), lambda t: t != "")
    if how == "words":
        return F.regexp_extract_all(F.lower(text), F.lit(WORD_TOKEN), F.lit(0))
    if how == "punct":
        return F.regexp_extract_all(text, F.lit(PUNCT_TOKEN), F.lit(0))
    if how == "entities":
        return F.regexp_extract_all(text, F.lit(ENTITY_TOKEN), F.lit(0))
    raise ValueError(f"unknown tokenizer {how!r}")


def _one_of(word: Column, words) -> Column:
    """Set membership; the optimizer turns the literal list into a hash set."""
    return word.isin(list(words))


def keep_token(
    token: Column,
    mode: str = "language",
    stop_words: Sequence[str] = lexicon.STOP_WORDS,
    number_words: Sequence[str] = lexicon.NUMBER_WORDS,
) -> Column:
    """True for tokens that carry meaning.

    'language' drops stop words, e-mails, URLs, numbers (digits or words) and punctuation; 'symbols' is the older rule:
    stop words, single punctuation signs and single digits only.
    """
    low = F.lower(token)
    if mode == "symbols":
        return ~_one_of(low, stop_words) & ~token.rlike(r"^[\p{Punct}0-9]$")
    if mode != "language":
        raise ValueError(f"unknown token filter {mode!r}")
    plain = token.rlike(r"^\p{L}+$")
    special = token.rlike(EMAIL) | low.rlike(URL) | token.rlike(NUMBER) | token.rlike(PUNCT_ONLY)
    return ~_one_of(low, [*stop_words, *number_words]) & (plain | ~special)


def token_filters(tokens: Column, mode: str = "language", **lists) -> Column:
    """Keep the tokens that pass :func:`keep_token`."""
    return F.filter(tokens, lambda t: keep_token(t, mode, **lists))


def lemma(token: Column, lemmas: dict[str, str] = lexicon.LEMMAS) -> Column:
    """Dictionary form of a token: irregular forms first, then plural endings, else the token in lower case."""
    return _lemma_of_lower(F.lower(token), lemmas)


def _lemma_of_lower(low: Column, lemmas: dict[str, str] = lexicon.LEMMAS) -> Column:
    size = F.length(low)
    rules = F.when(~low.endswith("s"), low)
    if lemmas:
        table = F.expr("map(" + ", ".join(sql_literal(x) for pair in sorted(lemmas.items()) for x in pair) + ")")
        rules = F.when(_one_of(low, lemmas), F.element_at(table, low)).when(~low.endswith("s"), low)
    return (
        rules.when(low.endswith("ies") & (size > 4), F.concat(low.substr(F.lit(1), size - 3), F.lit("y")))
        .when(low.rlike("(?:ss|x|ch|sh|zz)es$") & (size > 4), low.substr(F.lit(1), size - 2))
        .when((size > 3) & ~low.rlike("(?:ss|us|is|as)$"), low.substr(F.lit(1), size - 1))
        .otherwise(low)
    )


def lemmatise_tokens(tokens: Column) -> Column:
    """Lemma of every token in an array."""
    return F.transform(tokens, lambda t: lemma(t))


def lemma_words(text: Column) -> Column:
    """Lemmas of the meaningful words of a text as an array.

    The same words as ``lemmatise_tokens(token_filters(tokenise(text, 'entities')))``, found with fewer steps per word:
    e-mails and URLs are cut out of the lower-cased text, the rest is split at everything that is no letter, digit or
    underscore, and only stop words, number words and all-digit words are left to drop.
    """
    dropped = [*lexicon.STOP_WORDS, *lexicon.NUMBER_WORDS, ""]

    def words(low: Column) -> Column:
        bare = F.when(low.rlike(ADDRESS_HINT), F.regexp_replace(low, ADDRESS, " ")).otherwise(low)
        kept = F.filter(F.split(bare, NON_WORD), lambda w: ~_one_of(w, dropped) & ~w.rlike(NO_LETTER))
        return F.transform(kept, lambda w: _lemma_of_lower(w))

    return bind_once(F.lower(text), words)


def lemmatise(text: Column) -> Column:
    """Meaningful words in dictionary form, lower case, joined by one space."""
    return F.array_join(lemma_words(text), " ")


def clean_text(text: Column) -> Column:
    """Accents folded, meaningful words in dictionary form, punctuation gone: strip_punct(lemmatise(fold_accents)).

    Words hold letters, digits and underscores only, so without an underscore in the text the punctuation step comes down
    to dropping one-character words.
    """

    def clean(raw: Column) -> Column:
        words = lemma_words(fold_accents(raw))
        short = F.array_join(F.filter(words, lambda w: F.length(w) > 1), " ")
        return F.when(F.contains(raw, F.lit("_")), strip_punct(F.array_join(words, " "))).otherwise(short)

    return bind_once(text, clean)


def ngrams(tokens: Column, low: int = 1, high: int = 1, sep: str = " ") -> Column:
    """All n-grams with low <= n <= high, in order of n, then position."""
    if not 1 <= low <= high:
        raise ValueError("ngram range needs 1 <= low <= high")

    def of_size(words: Column, n: int) -> Column:
        if n == 1:
            return words
        last = F.array_size(words) - (n - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), sep))

    def of_sizes(words: Column) -> Column:
        return F.concat(*[of_size(words, n) for n in range(low, high + 1)])

    return tokens if (low, high) == (1, 1) else bind_once(tokens, of_sizes)


def parse_ngram_range(text: str) -> tuple[int, int]:
    """'1,2' -> (1, 2)."""
    low, high = (int(p) for p in text.strip("() ").split(","))
    return low, high


# ---- lengths and model text -----------------------------------------------------------------------------------------


def word_length(text: Column) -> Column:
    """Number of pieces between single spaces; the empty string has one, null stays null."""
    return F.array_size(F.split(text, " "))


def raw_lengths(df: DataFrame, html: str, key: str) -> DataFrame:
    """Word counts of the uncleaned text and code blocks of each record."""
    return df.select(
        key,
        word_length(block_text(F.col(html), "p")).alias("body_words"),
        word_length(block_text(F.col(html), "code")).alias("code_words"),
    )


def model_text(*cols: str, sep: str = "") -> Column:
    """Text columns joined without a separator; null in any of them gives null. ``sep=' '`` is the opt-in variant."""
    parts: list[Column] = []
    for name in cols:
        if parts and sep:
            parts.append(F.lit(sep))
        parts.append(F.col(name))
    return F.concat(*parts)
