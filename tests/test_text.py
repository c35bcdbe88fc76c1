"""Golden strings and edge cases of the text and tag functions."""

import pytest
from pyspark.sql import functions as F

from textmill.functions import lexicon, numeric
from textmill.functions import tags as T
from textmill.functions import text as X


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


PAGE = (
    "<p>As you are using this VHOST on port 8080. You need to mention in URL as below.</p>"
    "<pre><code>http://pizza.local:8080/ </code></pre>"
)
SENTENCE = "As you are using this VHOST on port 8080. You need to mention in URL as below."


@pytest.mark.parametrize(
    "html, text, code",
    [
        (PAGE, SENTENCE, "http://pizza.local:8080/"),
        ("", "", ""),
        (None, "", ""),
        # an escaped tag is text, an unclosed block runs to the end
        (PAGE.replace("<p>", "&lt;p>").replace("</code>", "&lt;/code>"), "", "http://pizza.local:8080/ </code>"),
        ("<p>use <code>ls</code> now</p>", "use ls now", "ls"),
        ("<p>one<p>two", "one two", ""),
        ("<p>a<script>var t='</p>';</script>b</p>", "ab", ""),
        ("<p>a<!-- <p>x</p> -->b</p><P class='x'>c</P>", "ab c", ""),
        ("<p>1 &lt; 2 &amp;amp; 3</p>", "1 < 2 &amp; 3", ""),
        ("<pre>x</pre><p>y</p>", "y", ""),
    ],
)
def test_blocks(spark, html, text, code):
    def squeezed(tag):
        return lambda c: F.trim(F.regexp_replace(X.block_text(c, tag), r"\s+", " "))

    assert one(spark, html, squeezed("p")) == text
    assert one(spark, html, squeezed("code")) == code


@pytest.mark.parametrize(
    "raw, folded",
    [
        (
            "Jeder Mensch sollte eine Ausbildung geniessen dürfen. Was meinst du, René?",
            "Jeder Mensch sollte eine Ausbildung geniessen durfen. Was meinst du, Rene?",
        ),
        (r"geniessen d\xc3\xbcrfen. Ren\xc3\xa9.", r"geniessen d\xc3\xbcrfen. Ren\xc3\xa9."),
        ("", ""),
        (None, ""),
        ("Straße, Æsir, œuvre, Łódź, “x” – 5€", 'Strasse, AEsir, oeuvre, Lodz, "x" - 5EUR'),
        ("éß", "ess"),
    ],
)
def test_fold_accents(spark, raw, folded):
    assert one(spark, raw, X.fold_accents) == folded


@pytest.mark.parametrize(
    "raw, clean", [("Swift: Drag a UIView between two other UIViews", "swift drag uiview uiview"), ("", "")]
)
def test_lemmatise(spark, raw, clean):
    assert one(spark, raw, X.lemmatise) == clean


SNIPPET = """'
    def calculator(x:str, y:list) ->int:
        multiplication=[x*element for element in y]
        return sum(multiplication)"""


@pytest.mark.parametrize(
    "raw, clean",
    [
        (SNIPPET, "def calculator str list int multiplication element for element in return sum multiplication"),
        ("", ""),
        ("8080 ab", "ab"),
        ("a bb\tc_d  ee!!ff", "bb ee ff"),
    ],
)
def test_strip_punct(spark, raw, clean):
    assert one(spark, raw, X.strip_punct) == clean


@pytest.mark.parametrize(
    "token, kept",
    [
        ("The", False), ("bob@mail.example.org", False), ("https://example.org/x", False), ("www.example.org", False),
        ("1,000", False), ("3.14", False), ("three", False), ("...", False), ("table", True), ("c3po", True), ("_", False),
    ],
)
def test_keep_token(spark, token, kept):
    assert one(spark, token, X.keep_token) is kept


def test_symbol_filter(spark):
    got = one(spark, "the a1 5 55 ! table", lambda c: X.token_filters(X.tokenise(c), "symbols"))
    assert got == ["a1", "55", "table"]


def test_lemmatise_agrees_with_token_steps(spark):
    text = "Mail bob@mail.example.org or see http://x.example/a?b=1, buy 1,000 boxes; queries_all classes went, x_y 3.5 don't"
    fast = one(spark, text, X.lemma_words)
    slow = one(spark, text, lambda c: X.lemmatise_tokens(X.token_filters(X.tokenise(c, "entities"))))
    assert fast == slow
    assert "box" in fast and "class" in fast and "go" in fast


def test_clean_text_is_composition_and_idempotent(spark):
    text = "Äpfel & birds_of two Fields: 42 queries, bob@x.example.org"
    whole = one(spark, text, X.clean_text)
    steps = one(spark, text, lambda c: X.strip_punct(X.lemmatise(X.fold_accents(c))))
    assert whole == steps
    plain = one(spark, "Äpfel & two Fields: 42 queries, bob@x.example.org", X.clean_text)
    assert plain == "apfel field query" == one(spark, plain, X.clean_text)


def test_ngrams(spark):
    assert one(spark, "a b c", lambda c: X.ngrams(X.tokenise(c), 1, 3)) == ["a", "b", "c", "a b", "b c", "a b c"]
    assert one(spark, "a", lambda c: X.ngrams(X.tokenise(c), 2, 3)) == []
    assert X.parse_ngram_range("(1, 2)") == (1, 2)
    with pytest.raises(ValueError):
        X.ngrams(F.array(), 2, 1)


def test_tokenizer_callable(spark):
    assert one(spark, "a-b", lambda c: X.tokenise(c, lambda x: F.split(x, "-"))) == ["a", "b"]
    with pytest.raises(ValueError):
        X.tokenise(F.col("x"), "none")


def test_lengths_and_model_text(spark):
    assert one(spark, "", X.word_length) == 1
    assert one(spark, None, X.word_length) is None
    df = spark.createDataFrame([("a", "b"), ("a", None)], "t string, c string")
    assert [r[0] for r in df.select(X.model_text("t", "c")).collect()] == ["ab", None]
    assert df.select(X.model_text("t", "c", sep=" ")).first()[0] == "a b"


def test_tags(spark):
    kind = "array<string>"
    row = ["php", "c", "php", "zzz"]
    assert one(spark, row, lambda c: T.intersect_tags(c), kind) == ["php", "c"]
    assert one(spark, None, lambda c: T.intersect_tags(c), kind) == []
    assert one(spark, row, lambda c: T.build_tag(c, ["php"]), kind) == ["php", "php"]
    assert one(spark, [], T.first_label, kind) == "other-tags"
    assert one(spark, row, T.powerset_label, kind) == "c|php|zzz"
    assert one(spark, "a|b", T.split_tags) == ["a", "b"]
    assert len(lexicon.ALLOWED_TAGS) == 50
    df = spark.createDataFrame([(1, []), (2, ["a"]), (3, ["a", "b"])], "id int, tags array<string>")
    assert [r.id for r in T.all_tags_in(df, ["a"]).orderBy("id").collect()] == [1, 2]


def test_numbers(spark):
    a, b = [2, 0, 1, 1, 1, 1, 1, 1, 1, 0], [0, 2, 2, 1, 1, 0, 0, 0, 1, 1]
    df = spark.createDataFrame([(a, b)], "a array<int>, b array<int>")
    euclid, cosine = df.select(
        numeric.distance(F.col("a"), F.col("b")), numeric.distance(F.col("a"), F.col("b"), "cosine")
    ).first()
    assert euclid == pytest.approx(13**0.5)
    assert cosine == pytest.approx(1 - 5 / ((11**0.5) * (12**0.5)))
    assert one(spark, 12, numeric.fingerprint_bucket, "bigint") == 51
    classes = [one(spark, s, numeric.cost_class, "double") for s in (59.9, 60.0, 299.0, 300.0)]
    assert classes == ["TIME-OK", "TIME-ERROR1", "TIME-ERROR1", "TIME-ERROR2"]


def test_character_codes(spark):
    cases = {
        "<p>a &#233; &#xE9; &#XE9;</p>": "a é é é", "<p>&#34;x&#x22; &#128512;</p>": '"x" 😀', "<p>&#38;lt; &amp;#60; &#x26;</p>": "&lt; &#60; &",
        "<p>&#; &#x; &#xD800; &#1114112; &#99999999; &#65</p>": "&#; &#x; &#xD800; &#1114112; &#99999999; &#65", "<p>&#39;&#39;</p>": "''", "<p>none</p>": "none",
    }
    df = spark.createDataFrame([(k,) for k in cases], "html string")
    for row in df.select("html", X.block_text(F.col("html"), "p").alias("got")).collect():
        assert row.got == cases[row.html], row.html
