"""Surrogates for personal data: keyed, type-consistent and distinct replacements.

Mentions are found in whole texts and reduced to entities, a kind and a canonical
form, so that one entity written in several ways stays one. Each entity gets a
surrogate from a keyed hash of its form. Surrogates are checked against all others
and against all entities of the corpus; who loses a clash tries again with the next
number, in rounds over the table of entities, until none is left. Thus different
entities stay different, and one entity gets the same surrogate everywhere.

A surrogate has the format of the mention: digits stand for digits, letters for
letters of the same case, punctuation stays, card numbers keep their length, issuer
digit and check digit, addresses stay addresses of their class, and names are drawn
for the script and the gender of the name, given and family names apart, so that a
full name and a later title with the family name still belong together.

Names are found behind a title and then again in the whole document without one. A name
whose title tells no gender is of its own kind.

Null texts stay null. Repeated rows stay repeated. Rows without a mention are neither
shuffled nor changed.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partatlas.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rounds in which a surrogate must also differ from every entity of the corpus;
#: beyond them, which needs a nearly full range of values, only from other surrogates.
FRESH_ROUNDS = 16
LAST_ROUND = 64

_TITLES = {
    "latin": {"m": ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Signor"),
              "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Signora"),
              "n": ("Dr", "Prof", "Doctor", "Professor")},
    "cyrillic": {"m": ("господин", "г-н", "Господин"), "f": ("госпожа", "г-жа", "Госпожа")},
    "greek": {"m": ("κύριος", "Κύριος", "κ."), "f": ("κυρία", "Κυρία", "κα")},
}
_UPPER = {"latin": "A-ZÀ-ÖØ-Þ", "cyrillic": "А-ЯЁ", "greek": "Α-ΩΆΈΉΊΌΎΏ"}
_LOWER = {"latin": "a-zß-öø-ÿ", "cyrillic": "а-яё", "greek": "α-ωάέήίόύώς"}
_SYLLABLES = {
    "latin": (tuple("bdfgklmnprstv"), tuple("aeiou"), {"m": ("n", "s", "ro"), "f": ("a", "ia", "la")}),
    "cyrillic": (tuple("бвгдзклмнпрст"), tuple("аеиоу"), {"m": ("н", "р", "слав"), "f": ("на", "ра", "я")}),
    "greek": (tuple("βγδζκλμνπρστ"), tuple("αειου"), {"m": ("ος", "ης", "ων"), "f": ("α", "η", "ια")}),
}
_FAMILY_ENDS = {"latin": ("er", "in", "ard", "ell"), "cyrillic": ("ко", "юк", "ян", "ых"),
                "greek": ("ίδη", "άκη", "ου", "έα")}
#: Given names by script and gender, fixed values.
GIVEN = {
    ("latin", "f"): "Anna Clara Elena Julia Laura Maria Nora Sarah Marta Irene Alice Emma".split(),
    ("latin", "m"): "Adam Daniel Felix Hugo Jonas Leon Martin Oscar Paul Simon Victor David".split(),
    ("cyrillic", "f"): "Анна Вера Елена Ирина Мария Нина Ольга Татьяна".split(),
    ("cyrillic", "m"): "Борис Виктор Иван Максим Николай Олег Павел Сергей".split(),
    ("greek", "f"): "Άννα Ελένη Μαρία Σοφία Ειρήνη Κατερίνα".split(),
    ("greek", "m"): "Νίκος Γιώργος Πέτρος Κώστας Ανδρέας Μιχάλης".split(),
}


def _name_pattern(script: str) -> str:
    titles = sorted((t for g in _TITLES[script].values() for t in g), key=len, reverse=True)
    u, lo = _UPPER[script], _LOWER[script]
    part = f"[{u}](?:[{lo}]+(?:[-'’][{u}][{lo}]+)?|[{u}]+)"
    # A degree between the title and the name is no part of the name.
    degrees = r"(?:(?:Dr|Prof)\b\.? )*" if script == "latin" else ""
    return rf"(?<!\w)(?P<title_{script}>{'|'.join(map(re.escape, titles))})\.? {degrees}(?P<name_{script}>{part}(?: {part}){{0,2}})"


_CREDENTIAL = "token|secret|password|passwd|api[_-]?key|access[_-]?key"
#: Each credential word has one of them.
_CREDENTIAL_PARTS = ("token", "secret", "passw", "key")
#: Beginnings of keys that services hand out, fixed values; a surrogate keeps them.
_KEY_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk-")
#: Letters and digits that a secret has at least, so that there are surrogates enough.
_SECRET_SIGNS = 6
_PATTERN = re.compile("|".join((
    r"(?P<email>[\w%+-][\w.%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,})",
    # A value goes up to its quote, or is a word without punctuation at its ends.
    rf"(?i:(?<![A-Za-z0-9])(?:{_CREDENTIAL}))(?P<sign>[\"']?\s*[=:]\s*)(?P<quote>[\"']?)"
    r"(?P<secret>(?:(?!(?P=quote))[^\n])+(?=(?P=quote))|(?:(?!(?P=quote))\S)+(?=(?P=quote))"
    r"|[\w+/=-](?:[^\s\"'<>,;&]*[\w+/=-])?)",
    r"(?<![A-Za-z0-9])[Bb]earer +(?P<bearer>[A-Za-z0-9._~+/-]{16,}=*)",
    rf"(?<![A-Za-z0-9])(?:{'|'.join(_KEY_PREFIXES)})(?P<prefixed>[A-Za-z0-9_-]{{16,}})",
    r"(?<![A-Za-z0-9])(?P<accesskey>(?:AKIA|ASIA)[A-Z0-9]{16})(?![A-Za-z0-9])",
    r"(?<![\d.])(?P<ip>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?!\d|\.\d)",
    r"(?<![\w+])(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){1,4})(?!\d)",
    r"(?<![\d-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d-])",
    *map(_name_pattern, _TITLES),
)))
#: Phone numbers without a country code: an area in brackets, groups of three, three and
#: four digits, or a leading zero and a second group behind a sign.
_NATIONAL = re.compile(
    r"(?<![\w+.,/-])(?<!\d )(?:\(\d{2,5}\) ?\d{3,4}[ .-]?\d{3,4}|\d{3}([ .-])\d{3}\1\d{4}"
    r"|0\d{1,4}[ /-]\d{3,8}(?:[ -]\d{2,5}){0,3})(?![\d/]|[.,-]\d)")
#: Digits that may hold a card number, in groups between single spaces or hyphens.
_DIGITS = re.compile(r"(?<!\d)\d(?:[ -]?\d){12,}")
_CARD_DIGITS = range(13, 20)
#: Beginnings of titles in Latin letters.
_HINTS = ("Mr", "Ms", "Mme", "Miss", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Signor", "Dr", "Prof", "Doctor", "earer ", *_KEY_PREFIXES)


def may_hold(text: Column) -> Column:
    """Whether a text can have a mention: a digit, an at sign, a Greek or Cyrillic
    letter, the beginning of a title, or a sign and a part of a credential word (a long
    s matches an s, but has no other lower case)."""
    sure = reduce(Column.__or__, map(text.contains, _HINTS), text.rlike("[0-9@\u0370-\u04ff]"))
    low = F.lower(text)
    words = reduce(Column.__or__, map(low.contains, _CREDENTIAL_PARTS), text.contains("ſ"))
    return sure | ((text.contains("=") | text.contains(":")) & words)


#: Country codes of one and two digits, fixed values; all others have three.
_ONE_DIGIT = "17"
_TWO_DIGITS = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
               "81 82 84 86 90 91 92 93 94 95 98").split()


def _country_code(digits: str) -> str:
    """Country code of an international number, however its groups are written."""
    return digits[: 1 if digits[0] in _ONE_DIGIT else 2 if digits[:2] in _TWO_DIGITS else 3]


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def _cards(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, str, str]]:
    """Card numbers outside the places taken: whole groups of digits of a card's length
    with a right check digit, whatever numbers stand before or behind them.

    Of numbers that overlap, those that begin and are long as cards are go first, then
    the longer, then the earlier one.
    """
    for run in _DIGITS.finditer(text):
        groups = [m.span() for m in re.compile(r"\d+").finditer(text, *run.span())]
        near = [(a, b) for a, b in taken if a < run.end() and run.start() < b]
        free = [not any(a < y and x < b for a, b in near) for x, y in groups]
        passed = []
        for i in range(len(groups)):
            digits = ""
            for j in range(i, len(groups)):
                digits += text[slice(*groups[j])]
                if not free[j] or len(digits) >= _CARD_DIGITS.stop:
                    break
                if len(digits) in _CARD_DIGITS and luhn(digits):
                    likely = digits[0] in "3456" and len(digits) in (14, 15, 16)
                    passed.append((not likely, -len(digits), i, j, digits))
        used = [False] * len(groups)
        for *_, i, j, digits in sorted(passed):
            if not any(used[i : j + 1]):
                used[i : j + 1] = [True] * (j + 1 - i)
                yield groups[i][0], groups[j][1], "card", digits


def mentions(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Start, end (code points), kind and canonical form of each mention, in order.

    Kinds are a type and what a surrogate must keep, as in ``name:latin:f:given``.
    Numbers of card length that fail the check digit are not cards.
    """
    found = list(_patterned(text))
    for more in (_cards, _national):
        found += more(text, [x[:2] for x in found])
    yield from sorted([*found, *_names_again(text, found)])


def _outside(spans: Iterator[tuple[int, int]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Those of the spans, in order, that meet none of the places taken."""
    taken, at = sorted(taken), 0
    for a, b in spans:
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if at == len(taken) or taken[at][0] >= b:
            yield a, b


def _national(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, str, str]]:
    """Phone numbers without a country code, outside the places taken."""
    for a, b in _outside((m.span() for m in _NATIONAL.finditer(text)), taken):
        digits = re.sub(r"\D", "", text[a:b])
        if len(digits) >= 8:
            yield a, b, f"phone:n{'0' if digits[0] == '0' else ''}", digits


def _names_again(text: str, found: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int, str, str]]:
    """Names of a document wherever else it has them with a capital letter, whether or
    not a title stands before them. A part that is several entities is the first one."""
    names: dict[str, tuple[str, str]] = {}
    for *_, kind, form in sorted(found):
        if kind.startswith("name:"):
            names.setdefault(form, (kind, form))
    if not names:
        return
    words = (m.span() for m in re.compile(r"\w+(?:[-'’]\w+)*").finditer(text) if m[0][0].isupper())
    for a, b in _outside(words, [x[:2] for x in found]):
        word = text[a:b]
        # A possessive ending or the other half of a hyphenated word is no part of it.
        parts = [(0, word), *((m.start(), m[0]) for m in re.compile(r"\w+").finditer(word) if m[0] != word)]
        end = 0
        for at, part in parts:
            if at >= end and part[0].isupper() and part.casefold() in names:
                end = at + len(part)
                yield a + at, a + end, *names[part.casefold()]


def _patterned(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Mentions that a pattern alone tells."""
    for m in _PATTERN.finditer(text):
        kind = m.lastgroup
        if kind.startswith(("title_", "name_")):
            script = kind.partition("_")[2]
            title = m[f"title_{script}"]
            gender = next(g for g, ts in _TITLES[script].items() if title in ts)
            at, parts = m.start(f"name_{script}"), m[f"name_{script}"].split(" ")
            for i, part in enumerate(parts):
                last = i == len(parts) - 1
                kind = f"name:{script}:{'n' if last and script == 'latin' else gender}:{'family' if last else 'given'}"
                yield at, at + len(part), kind, part.casefold()
                at += len(part) + 1
            continue
        start, end = m.span(kind)
        found = m[kind]
        if kind == "email":
            yield start, end, kind, found.lower()
        elif kind == "phone":
            digits = re.sub(r"\D", "", found)
            yield start, end, f"phone:+{_country_code(digits)}", digits
        elif kind == "ssn":
            yield start, end, kind, re.sub(r"\D", "", found)
        elif kind == "ip":
            octets = [int(x) for x in found.split(".")]
            inside = octets[0] == 10 or octets[:2] == [192, 168] or octets[0] == 172 and 16 <= octets[1] < 32
            yield start, end, "ip:private" if inside else "ip:public", ".".join(map(str, octets))
        elif kind in ("bearer", "prefixed"):
            yield start, end, "secret", found
        elif kind == "accesskey" or _is_secret(found, m["sign"], m["quote"]):
            yield start, end, kind, found


def _is_secret(value: str, sign: str, quote: str) -> bool:
    """Whether a value behind a credential word is one: behind a colon and without
    quotes, a short word of letters alone is prose."""
    if sum(c.isalnum() for c in value) < _SECRET_SIGNS:
        return False
    return bool(quote) or "=" in sign or len(value) >= 12 or not value.isalpha()


class _Stream:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts: object) -> None:
        self.seed, self.key, self.n, self.pool = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), key, 0, 0
        self.left = 1

    def below(self, n: int) -> int:
        if self.left < 1 << 32:
            digest = hashlib.blake2b(self.seed + self.n.to_bytes(4, "big"), key=self.key).digest()
            self.pool, self.left, self.n = int.from_bytes(digest, "big"), 1 << 512, self.n + 1
        self.pool, out = divmod(self.pool, n)
        self.left //= n
        return out


def _like(text: str, rng: _Stream, hexadecimal: bool = False) -> str:
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(rng.below(10)))
        elif c.isalpha():
            new = "abcdef"[rng.below(6)] if hexadecimal else chr(97 + rng.below(26))
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, form: str, key: bytes, attempt: int) -> str:
    """Replacement of a canonical form, itself canonical, of the same kind."""
    what, *rest = kind.split(":")
    rng = _Stream(key, kind, form, attempt)
    if what == "email":
        local, _, domain = form.partition("@")
        names = domain.rsplit(".", 1)[0]
        # One domain gets one name, whoever writes from it, below a reserved top level.
        return f"{_like(local, rng)}@{_like(names, _Stream(key, 'domain', domain, attempt))}.example"
    if what == "phone":
        code = rest[0][1:]
        return code + "".join(str(rng.below(10)) for _ in form[len(code):])
    if what == "ssn":
        return f"9{rng.below(10**8):08d}"
    if what == "card":
        body = form[0] + "".join(str(rng.below(10)) for _ in form[1:-1])
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if what == "ip":
        if rest[0] == "private":
            return ".".join(map(str, (10, *(rng.below(256) for _ in range(3)))))
        first = [x for x in range(1, 224) if x not in (10, 127, 172, 192)]
        return ".".join(map(str, (first[rng.below(len(first))], *(rng.below(256) for _ in range(3)))))
    if what == "accesskey":
        return form[:4] + _like(form[4:], rng)
    if what == "secret":
        return _like(form, rng, hexadecimal=re.fullmatch(r"[0-9a-fA-F]+", form) is not None)
    script, gender, role = rest
    onsets, vowels, ends = _SYLLABLES[script]
    syllables = "".join(onsets[rng.below(len(onsets))] + vowels[rng.below(len(vowels))]
                        for _ in range(2 + rng.below(2) + attempt // 8))
    if role == "family":
        end = _FAMILY_ENDS[script][rng.below(4)]
        return (syllables + end + ("а" if script == "cyrillic" and gender == "f" else "")).casefold()
    if gender == "n":
        gender = "fm"[rng.below(2)]
    names = GIVEN[script, gender]
    if attempt < 4:
        return names[rng.below(len(names))].casefold()
    return (syllables + ends[gender][rng.below(len(ends[gender]))]).casefold()


def render(kind: str, mention: str, form: str) -> str:
    """A surrogate form as the mention writes it."""
    what = kind.partition(":")[0]
    if what in ("phone", "ssn", "card"):
        digits = iter(form)
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if what == "email" and len(form) == len(mention):
        return "".join(n.upper() if c.isupper() else n for c, n in zip(mention, form))
    if what == "name":
        return form.upper() if len(mention) > 1 and mention.isupper() else form.capitalize()
    return form


def find_mentions(docs: DataFrame) -> DataFrame:
    """``digest`` of the text, ``start``, ``end``, ``kind``, ``form`` and ``mention``."""

    @F.pandas_udf("array<struct<start:int,end:int,kind:string,form:string,mention:string>>")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[(a, b, k, f, t[a:b]) for a, b, k, f in mentions(t)] for t in texts])

    return docs.filter(may_hold(F.col("text"))).select(
        _digest().alias("digest"), F.explode(find(F.col("text"))).alias("x")
    ).select("digest", "x.*").distinct()


def _digest() -> Column:
    return F.sha2("text", 256)


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind``, ``form`` and ``new`` for distinct entities, without any clash."""
    what = F.split_part("kind", F.lit(":"), F.lit(1)).alias("what")
    todo, done, attempt = entities, [], 0
    while True:
        n = attempt

        @F.pandas_udf("string")
        def candidate(kind: pd.Series, form: pd.Series) -> pd.Series:
            return pd.Series([surrogate(k, f, key, n) for k, f in zip(kind, form)], dtype=object)  # noqa: B023

        asked = todo.select("kind", "form", what, candidate("kind", "form").alias("new"))
        claims = [asked.select("what", "new", "form", F.lit(False).alias("gone"))]
        if attempt < FRESH_ROUNDS:
            claims.append(entities.select(what, F.col("form").alias("new"), "form", F.lit(True).alias("gone")))
        claims += [x.select(what, "new", "form", F.lit(True).alias("gone")) for x in done]
        won = reduce(DataFrame.union, claims).groupBy("what", "new").agg(
            F.min(F.struct("form")).alias("first"), F.max("gone").alias("gone"))
        asked_kind = asked.join(won, ["what", "new"]).select(
            "kind", "form", "new", (~F.col("gone") & (F.col("first.form") == F.col("form"))).alias("won"))
        tried = materialize(asked_kind, "surrogates")
        # One form may be asked for by two kinds; the smaller kind goes first.
        first = tried.filter("won").groupBy("form", "new").agg(F.min("kind").alias("kind"))
        done.append(first.select("kind", "form", "new"))
        todo = tried.select("kind", "form").join(done[-1].select("kind", "form"), ["kind", "form"], "left_anti")
        attempt += 1
        if todo.isEmpty():
            return reduce(DataFrame.union, done)
        if attempt == LAST_ROUND:
            raise ValueError("more entities of a kind than its format has values")


def with_surrogates(docs: DataFrame, key: str = "partatlas") -> DataFrame:
    """``row`` with the columns of ``docs`` and ``text`` replaced, and ``spans``, the
    replaced places: start and end in the old text, kind and new text; null if none.

    An ``n_chars`` column follows the new text.
    """
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    found = materialize(find_mentions(docs.select(F.col("text").cast("string"))), "mentions")
    mapping = materialize(assign(found.select("kind", "form").distinct(), secret), "surrogate-map")

    @F.pandas_udf("string")
    def rendered(kind: pd.Series, mention: pd.Series, new: pd.Series) -> pd.Series:
        return pd.Series([render(*x) for x in zip(kind, mention, new)], dtype=object)

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, places in zip(texts, spans):
            if places is not None:
                pieces, at = [], 0
                for x in places:
                    pieces += (text[at : x["start"]], x["new"])
                    at = x["end"]
                text = "".join((*pieces, text[at:]))
            out.append(text)
        return pd.Series(out, dtype=object)

    places = found.join(mapping, ["kind", "form"]).select(
        "digest", F.struct("start", "end", "kind", rendered("kind", "mention", "new").alias("new")).alias("x")
    ).groupBy("digest").agg(F.sort_array(F.collect_list("x")).alias("spans"))
    docs = docs.withColumn("text", F.col("text").cast("string"))
    rows = docs.select(
        "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    hinted = F.coalesce(may_hold(F.col("text")), F.lit(False))
    none = F.lit(None).cast("array<struct<start:int,end:int,kind:string,new:string>>")
    changed = rows.filter(hinted).withColumn("digest", _digest()).join(places, "digest", "left")
    changed = changed.select("row", "spans", replaced("text", "spans").alias("new"))
    kinds = {f.name: f.dataType for f in docs.schema}
    fields = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("new")}
    if "n_chars" in kinds:
        fields["n_chars"] = F.when(F.col("spans").isNotNull(), F.length("new").cast(kinds["n_chars"])).otherwise(
            fields["n_chars"])
    changed = changed.select(F.struct(*[v.alias(c) for c, v in fields.items()]).alias("row"), "spans")
    return changed.union(rows.filter(~hinted).select("row", none.alias("spans")))


def surrogate_rows(docs: DataFrame, key: str = "partatlas") -> DataFrame:
    """``docs`` with replaced texts."""
    return with_surrogates(docs, key).select("row.*")
