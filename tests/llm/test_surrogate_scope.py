"""Masked values and crowded forms."""

from __future__ import annotations

from textmill.llm import surrogates


def test_masked_values_are_no_secrets():
    for text in ("password: ********", "token: -------"):
        assert surrogates.rewrite(text) == (text, 0)
    assert surrogates.rewrite("password: ****x7**")[1] == 1


def test_crowded_and_unchangeable_forms_end(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    # every draw of the same length is a real address; digits of other scripts are never redrawn
    forms = [("email", f"{a}@{b}.org") for a in letters for b in letters] + [("secret", "\u0661\u0662\u0663\u0664\u0665\u0666\u0667")]
    rows = surrogates.distinct_surrogates(spark.createDataFrame(forms, "kind string, form string")).collect()
    assert len({r.new for r in rows}) == len(forms) == len(rows)
    assert not {r.new for r in rows} & {f for _, f in forms}


def test_untitled_mentions_and_parts_of_names_agree():
    new, count = surrogates.rewrite("Herr Hans Müller kam. Müller ging, Hans Müller auch; Müllers und MÜLLER nicht.")
    words = new.split()
    given, family = words[1], words[2]
    assert count == 3 and "Müller " not in new and "Hans" not in new
    assert words[4] == family and words[6:8] == [given, family]
    new, count = surrogates.rewrite("Mr. John Smith, Mr. Smith, Dr. Smith and Dr. JOHN SMITH")
    a, b, c, d = (x.split()[1:] for x in new.replace(" and", ",").split(", "))
    assert count == 4 and a[1:] == b == c and [x.upper() for x in a] == d
    assert surrogates.rewrite("John Smith")[1] == 0


def test_parts_with_later_attempts(spark):
    names = [f"{a}{b}{c}" for a in "BDFGHJKLMN" for b in "aeiou" for c in "bdfgk"]
    df = spark.createDataFrame([(i, f"Mr. {n} saw {n}. Dr. {n} left") for i, n in enumerate(names)], "doc_id long, text string")
    made = [r.text.split() for r in surrogates.replace_entities(df, "doc_id", "text").collect()]
    assert all(w[1] + "." == w[3] and w[5] == w[1] for w in made)
    assert len({w[1] for w in made}) == len(names)
