"""Surrogates for personal data: keyed, of the same type and format, distinct, and the same wherever an entity returns.

1. Detection: patterns with checks (Luhn, mod 97, ranges of octets) find e-mail addresses, phone and card numbers, IP
   addresses, social security and bank account numbers, access keys, assigned secrets and titled person names, with the untitled mentions of their full
   and family names in the same text. Surrogates are drawn for each part of a name, whatever its title or case. The entity
   behind a mention is its canonical form: two spellings of one phone number are one entity.
2. A surrogate is drawn from a keyed hash of (kind, canonical form, attempt). It keeps length, case, separators, country
   codes, check digits, top-level domains, the script and case of a name.
3. Collision checks over all distinct entities: a surrogate that equals another entity's surrogate or any real entity of
   its kind is drawn again with the next attempt, until all are distinct. After eight attempts e-mail addresses, secrets and
   names grow, and late attempts for phone numbers take any country code, so that crowded or unchangeable forms end too. Entities and drawings are tables; the few
   entities beyond the first attempt reach their documents by a join on the entity and the document.
4. The texts are rewritten in one pass that moves no rows unless a document holds an entity with a later attempt.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import batches_of, one_text, table
from textmill.staging import stage

KEY = b"change this key for every release of a corpus"
MAX_ATTEMPTS = 64

# -- detection -----------------------------------------------------------------------------------------------------------

_EMAIL = re.compile(r"(?<![\w.+-])[\w.+-]*\w@[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+")
_DIGITS = re.compile(r"[+(]?[0-9][0-9 ().-]{5,}[0-9]")
_IP = re.compile(r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|\.[0-9])")
_CARD = re.compile(r"(?<![\w+])[3-6](?:[0-9]{12,18}|[0-9]{3}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{3}([ -])[0-9]{6}\2[0-9]{5})(?!\w)")
_SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_PHONE = re.compile(r"(?<![\w.+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-][0-9]{4}(?!\w|-[0-9])")
_ABROAD = re.compile(r"(?<![\w+])\+[0-9](?:[ .-]?\(?[0-9]\)?){7,14}(?!\w)")
_ACCOUNT = re.compile(r"[A-Z]{2}(?<!\w..)[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_ACCESS = re.compile(r"AKIA(?<!\w.{4})[0-9A-Z]{16}(?!\w)")
_SECRET = re.compile(r"(?i:passw(?:or)?d|pwd|token|secret|api[_-]?key)[\"']?[ \t]*[=:][ \t]*[\"']?([^\s\"']{6,}[^\s\"'.,;])")
#: Titles by the gender of the name that follows (fixed values).
_TITLES = {
    "m": ["Mr", "Mr.", "Herr", "Herrn", "Monsieur", "Señor", "Sr.", "господин", "г-н"],
    "f": ["Mrs", "Mrs.", "Ms", "Ms.", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra.", "госпожа", "г-жа"],
    "n": ["Dr", "Dr.", "Prof.", "Mx", "Mx."],
}
_GENDER = {title: gender for gender, titles in _TITLES.items() for title in titles}
_NAME = re.compile(rf"(?<!\w)({'|'.join(re.escape(t) for t in sorted(_GENDER, key=len, reverse=True))}) ([^\W\d_a-zа-яё][^\W\d_]+(?:[ -][^\W\d_a-zа-яё][^\W\d_]+)?)(?!\w)")
_WORDS = re.compile(r"(?<!\w)[^\W\d_]+(?!\w)")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> int:
    """Sum of the card check, which is 0 modulo 10 for a valid number."""
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return sum(int(d) for d in digits[::-2]) + sum(d - 9 if d > 9 else d for d in doubled)


def account_rest(account: str) -> int:
    """Remainder of the account check, 1 for a valid number."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def _numbers(text: str) -> Iterator[tuple[int, int, str, str]]:
    for m in _IP.finditer(text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            yield m.start(), m.end(), "ip", ".".join(str(int(x)) for x in m[0].split("."))
    for m in _CARD.finditer(text):
        if luhn(_digits(m[0])) % 10 == 0:
            yield m.start(), m.end(), "card", _digits(m[0])
    for m in _SSN.finditer(text):
        yield m.start(), m.end(), "ssn", _digits(m[0])
    for m in _PHONE.finditer(text):
        digits = _digits(m[0])
        yield m.start(), m.end(), "phone", digits[-10:] if digits[:-10] in ("", "1") else f"+{digits}"
    for m in _ABROAD.finditer(text):
        digits = _digits(m[0])
        yield m.start(), m.end(), "phone", digits[1:] if len(digits) == 11 and digits[0] == "1" else f"+{digits}"


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the mentions, in order; of overlapping ones the first and longest stays."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in _EMAIL.finditer(text)]
    for cluster in _DIGITS.finditer(text):
        # the patterns look at most one sign to the left and two to the right of a run of digits and separators
        low, high = max(0, cluster.start() - 2), cluster.end() + 3
        found += [(a + low, b + low, kind, form) for a, b, kind, form in _numbers(text[low:high])]
    for m in _ACCOUNT.finditer(text):
        form = m[0].replace(" ", "")
        if 15 <= len(form) <= 34 and account_rest(form) == 1:
            found.append((m.start(), m.end(), "account", form))
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m[0]) for m in _ACCESS.finditer(text)]
    if "=" in text or ":" in text:
        found += [(m.start(1), m.end(1), "secret", m[1]) for m in _SECRET.finditer(text) if any(map(str.isalnum, m[1]))]  # else it is masked already
    if _may_hold_name(text):
        titled = [(m.start(2), m.end(2), f"name-{_GENDER[m[1]]}", m[2]) for m in _NAME.finditer(text) if m[2][0].isupper()]
        found += titled + list(_untitled(text, titled))
    found.sort(key=lambda x: (x[0], -x[1], x[2]))
    kept, end = [], 0
    for mention in found:
        if mention[0] >= end:
            kept.append(mention)
            end = mention[1]
    return kept


def _may_hold_name(text: str) -> bool:
    return any(f"{title} " in text for title in _GENDER)


def _untitled(text: str, titled: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int, str, str]]:
    """Other mentions of the full and family names that a title has shown in this text, with the kind of the first one."""
    known: dict[str, str] = {}
    for _, _, kind, name in titled:
        for form in (name, name.split(" ")[-1]):
            known.setdefault(form, kind)
    at = {start for start, *_ in titled}
    for m in _WORDS.finditer(text) if known else ():
        # a full name is one or two words joined by a sign; the longer one wins
        pair = _WORDS.match(text, m.end() + 1) if text[m.end() : m.end() + 1] in (" ", "-") else None
        for form in (text[m.start() : pair.end()] if pair else "", m[0]):
            if form in known and m.start() not in at:
                yield m.start(), m.start() + len(form), known[form], form
                break


def _parts(name: str) -> list[str]:
    return re.split("[ -]", name)


def entities_of(kind: str, form: str) -> list[tuple[str, str]]:
    """What surrogates are drawn for: the parts of a name, whatever its title and case, else the entity itself."""
    return [("name", p.lower()) for p in _parts(form)] if kind.startswith("name-") else [(kind, form)]


# -- surrogates ----------------------------------------------------------------------------------------------------------


class _Draw:
    """Keyed numbers below given bounds."""

    def __init__(self, key: bytes, *parts: object):
        self.seed = hashlib.blake2b("\x1f".join(map(str, parts)).encode(), key=hashlib.sha256(key).digest()).digest()
        self.number, self.left, self.count = 0, 0, 0

    def below(self, bound: int) -> int:
        if self.left < 64:
            block = hashlib.blake2b(self.seed + self.count.to_bytes(8, "big")).digest()
            self.number, self.left, self.count = int.from_bytes(block, "big"), 512, self.count + 1
        self.number, value = divmod(self.number, bound)
        self.left -= bound.bit_length()
        return value

    def like(self, sign: str) -> str:
        """A sign of the same class: digit, small or capital Latin letter; any other sign stays."""
        for letters in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
            if sign in letters:
                return letters[self.below(len(letters))]
        return sign if sign.isascii() or not sign.isalpha() else "abcdefghijklmnopqrstuvwxyz"[self.below(26)]


#: Syllables and endings of invented names by script: (starts, vowels, ends of a man's, woman's and any name), fixed values.
_SYLLABLES = {
    "latin": ("b d f g h j k l m n p r s t v z br dr gr kl st tr".split(), "a e i o u".split(), {"m": "n r s d l k".split(), "f": ["a", "ia", "na"], "n": "e i en el".split()}),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х бр гр др ст тр".split(), "а е и о у".split(), {"m": "н р с д л к в".split(), "f": ["а", "ия", "на"], "n": "е и ен ель".split()}),
}


def _name_part(draw: _Draw, script: str, gender: str, syllables: int) -> str:
    starts, vowels, ends = _SYLLABLES[script]
    body = "".join(starts[draw.below(len(starts))] + vowels[draw.below(len(vowels))] for _ in range(syllables))
    last = ends[gender][draw.below(len(ends[gender]))]
    return (body[:-1] if last[0] in vowels or last[0] in "ия" else body) + last


def surrogate(kind: str, form: str, attempt: int = 0, key: bytes = KEY) -> str:
    """Canonical form of the surrogate of an entity."""
    draw = _Draw(key, kind, form, attempt)
    wider = attempt // 8  # signs beyond the format when many draws were taken already
    if kind == "email":
        local, _, domain = form.rpartition("@")
        site, _, top = domain.rpartition(".")
        of_domain = _Draw(key, "domain", domain)  # one domain stays one domain
        return "".join(map(draw.like, local)) + "".join(draw.like("a") for _ in range(wider)) + "@" + "".join(map(of_domain.like, site)) + "." + top
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "card":
        body = form[0] + "".join(str(draw.below(10)) for _ in form[1:-1])
        return body + str(-luhn(body + "0") % 10)
    if kind == "ssn":
        return f"{100 + draw.below(799):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "phone":
        if form[0] != "+":
            return f"{2 + draw.below(8)}{draw.below(100):02d}{2 + draw.below(8)}{draw.below(100):02d}{draw.below(10_000):04d}"
        if attempt < MAX_ATTEMPTS // 2:
            return form[:3] + "".join(str(draw.below(10)) for _ in form[3:])
        return f"+{1 + draw.below(9)}" + "".join(str(draw.below(10)) for _ in form[2:])  # any country code
    if kind == "account":
        body = form[:2] + "00" + "".join(map(draw.like, form[4:]))
        return f"{body[:2]}{98 - account_rest(body):02d}{body[4:]}"
    if kind == "access":
        return form[:4] + "".join(map(draw.like, form[4:]))
    if kind == "secret":
        if re.fullmatch("[0-9a-f]+", form):
            return "".join("0123456789abcdef"[draw.below(16)] for _ in range(len(form) + wider))
        return "".join(map(draw.like, form)) + "".join(draw.like("a") for _ in range(wider))
    if kind == "name":  # one part of a name in small letters; its own ending, not a title, chooses the ending
        script = "cyrillic" if re.search("[а-яё]", form) else "latin"
        return _name_part(draw, script, "f" if form[-1] in "aая" else "m", 2 + wider)
    script = "cyrillic" if re.search("[а-яёА-ЯЁ]", form) else "latin"
    parts = re.split("([ -])", form)
    # the first of two names shows the gender; a family name does so in Cyrillic only
    made = [p if p in " -" else _name_part(draw, script, kind[-1] if i == 0 or script == "cyrillic" else "n", 2 + wider) for i, p in enumerate(parts)]
    return "".join(m if p in " -" else _cased(m, p) for m, p in zip(made, parts, strict=True))


def _cased(new: str, old: str) -> str:
    return new.upper() if old.isupper() and len(old) > 1 else new[0].upper() + new[1:]


def render(mention: str, kind: str, form: str, new: str) -> str:
    """The surrogate in the format of the mention."""
    if kind in ("phone", "card", "ssn", "account"):
        # the last signs of the mention take those of the surrogate; separators and a country code stay
        fresh = [c for c in new if c.isalnum()]
        out = []
        for sign in reversed(mention):
            out.append(fresh.pop() if sign.isalnum() and fresh else sign)
        return "".join(reversed(out))
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for n, o in zip(new, mention, strict=True)) if len(new) == len(mention) else new
    return new


@lru_cache(maxsize=100_000)
def _first_attempt(kind: str, form: str, key: bytes) -> str:
    return surrogate(kind, form, 0, key)


def rewrite(text: str, later: dict[tuple[str, str], int] | None = None, key: bytes = KEY) -> tuple[str, int]:
    """The text with surrogates and the number of mentions; ``later``: entities whose attempt is not the first."""
    out, end, mentions = [], 0, find_entities(text)
    for start, stop, kind, form in mentions:
        made = []
        for entity in entities_of(kind, form):
            attempt = (later or {}).get(entity, 0)
            made.append(surrogate(*entity, attempt, key) if attempt else _first_attempt(*entity, key))
        new = made[0]
        if kind.startswith("name-"):
            fresh = iter(made)
            new = "".join(p if p in " -" else _cased(next(fresh), p) for p in re.split("([ -])", form))
        out += [text[end:start], render(text[start:stop], kind, form, new)]
        end = stop
    return "".join([*out, text[end:]]), len(mentions)


# -- tables --------------------------------------------------------------------------------------------------------------


def mentions(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """``row_id``, ``kind``, ``form``: the distinct entities of every row; of a name its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch):
                rows, kinds, forms = [], [], []
                for i, value in enumerate(part.column(1).to_pylist()):
                    for kind, form in sorted({e for m in find_entities(value) for e in entities_of(*m[2:])}):
                        rows.append(i)
                        kinds.append(kind)
                        forms.append(form)
                yield pa.record_batch([part.column(0).take(pa.array(rows, pa.int64())), pa.array(kinds, pa.string()), pa.array(forms, pa.string())], ["row_id", "kind", "form"])

    chosen = df.select(F.col(id_column).alias("row_id"), one_text(text).alias("text"))
    return chosen.mapInArrow(run, f"row_id {chosen.schema[0].dataType.simpleString()}, kind string, form string")


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, attempt) plus ``new``: the surrogate of that attempt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [surrogate(k, f, a, key) for k, f, a in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            yield pa.record_batch([*batch.columns, pa.array(new, pa.string())], ["kind", "form", "attempt", "new"])

    return entities.select("kind", "form", F.col("attempt").cast("int").alias("attempt")).mapInArrow(run, "kind string, form string, attempt int, new string")


def distinct_surrogates(entities: DataFrame, key: bytes = KEY, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """``kind``, ``form``, ``attempt``, ``new`` for distinct entities: no two share a surrogate, none has a real one.

    Names of all genders and titles share one space. An entity that was settled in an earlier round keeps its surrogate.
    """
    space = F.regexp_replace("kind", "-.*", "")
    real = stage(entities.select(space.alias("space"), F.col("form").alias("new")).distinct(), "entity-forms")
    drawn = stage(_drawn(entities.withColumn("attempt", F.lit(0)), key), "surrogates")
    for _ in range(max_attempts):
        spaced = drawn.withColumn("space", space)
        shared = spaced.groupBy("space", "new").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "kind", "form")).alias("first")).where("n > 1")
        lost = spaced.join(shared, ["space", "new"]).where(F.struct("attempt", "kind", "form") != F.col("first")).select("kind", "form")
        taken = spaced.join(real, ["space", "new"], "left_semi").select("kind", "form")
        again = stage(lost.unionByName(taken).distinct().withColumn("again", F.lit(1)), "collisions")
        if again.isEmpty():
            return drawn
        next_attempt = F.col("attempt") + F.coalesce("again", F.lit(0))
        settled = drawn.join(again, ["kind", "form"], "left_anti")
        redrawn = _drawn(drawn.join(again, ["kind", "form"]).withColumn("attempt", next_attempt), key)
        drawn = stage(settled.unionByName(redrawn), "surrogates")
    raise ValueError("a kind of entity has more members than surrogates")


def replace_entities(df: DataFrame, id_column: str, text: str, key: bytes = KEY) -> DataFrame:
    """All columns of ``df`` with surrogates in the text, plus ``n_entities`` (replaced if there).

    Null texts stay null with 0 entities; texts without entities stay as they are. Repeated rows and rows with equal or null
    ids are rewritten each for itself. An empty table gives no rows.
    """
    found = stage(mentions(df, id_column, text), "mentions")
    drawn = distinct_surrogates(found.select("kind", "form").distinct(), key)
    later = drawn.where("attempt > 0").select("kind", "form", "attempt")
    base = df.drop("n_entities")
    names = base.columns
    kind = "array<struct<kind: string, form: string, attempt: int>>"
    if later.isEmpty():
        ready = base.withColumn("__later", F.lit(None).cast(kind))
    else:
        of_rows = found.join(later, ["kind", "form"]).groupBy("row_id").agg(F.collect_set(F.struct("kind", "form", "attempt")).alias("__later"))
        of_rows = stage(of_rows, "later-attempts").withColumnRenamed("row_id", "__row")
        ready = base.join(of_rows, F.col(id_column).eqNullSafe(F.col("__row")), "left").drop("__row")
    place = names.index(text)
    schema = T.StructType([*[base.schema[n] for n in names], T.StructField("n_entities", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch):
                columns, held = part.columns[:-1], part.columns[-1].to_pylist()
                done = [
                    (None, 0) if t is None else rewrite(t, {(x["kind"], x["form"]): x["attempt"] for x in later or ()}, key)
                    for t, later in zip(columns[place].to_pylist(), held, strict=True)
                ]
                columns[place] = pa.array([t for t, _ in done], columns[place].type)
                yield pa.record_batch([*columns, pa.array([n for _, n in done], pa.int64())], [*names, "n_entities"])

    return ready.select(*[F.col(f"`{n}`") for n in names], "__later").mapInArrow(run, schema)


def document_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    return replace_entities(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")


def hide_entities(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """The documents with surrogates in their texts; their columns stay, ``n_chars`` follows the new text."""
    done = replace_entities(docs, "doc_id", "text").select(*[F.col(f"`{c}`") for c in docs.columns])
    if "n_chars" not in docs.columns:
        return done
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.withColumn("n_chars", length)
