"""Surrogates for personal data: keyed, consistent, distinct and of the same form (operator 1). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table
from .spans import let

EMAIL = r"(?<![\p{L}\p{M}\p{N}_.%+-])[\p{L}\p{M}\p{N}_.%+-]++@[\p{L}\p{M}\p{N}-]+(?:\.[\p{L}\p{M}\p{N}-]+)+"
ADDRESS = r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)"
CARD = r"(?<![\w-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])"
NUMBER = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = r"(?:(?<![\w+])\+\d{1,3}[ .-]?)?(?<![\w-])\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}(?![\w-])"
INTL = r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{1,5}\)?){2,5}(?![\w-])"
IBAN = r"(?<![\w-])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![\w-])"
#: A date after words that tell of a birth.
BORN = r"(?<=(?i:born |born: |born on |born on the |dob |dob: |date of birth |date of birth: |geboren am |né le |née le |nacido el |nacida el ))(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?!\d)"
#: Titles by the gender they tell (m, f, or n: none).
TITLES = {"m": "Mr|Herr|Señor|Sr|Monsieur", "f": "Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|Mlle", "n": "Dr|Prof"}
NAME = r"\p{Lu}(?:[\p{L}\p{M}]|['’-](?=\p{L}))*"
TITLE = rf"(?:{'|'.join(TITLES.values())})\b\.?"
PERSON = rf"(?<!\p{{L}}){TITLE}(?:\x20{TITLE})*(?:\x20{NAME}){{1,3}}"
#: At most places of a text one look at the next character rules out all but an email.
ENTITY = rf"{EMAIL}|(?=[\d+(])(?:{'|'.join((ADDRESS, CARD, NUMBER, INTL, PHONE, BORN))})|(?=\p{{Lu}})(?:{IBAN}|{PERSON})"
#: Kinds by the first pattern that fits a whole match.
KINDS = (("email", "@"), ("ip", r"^\d{1,3}(?:\.\d{1,3}){3}$"), ("iban", r"^[A-Z]{2}\d{2}[\x20A-Z0-9]+$"), ("birth", r"^(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})$"), ("ssn", f"^(?:{NUMBER})$"), ("card", f"^(?:{CARD})$"), ("phone", r"^[+(\d]"), ("person", rf"^(?:{'|'.join(TITLES.values())})\b\.?\x20"), ("name", "."))

#: Sounds of generated names by script: 16 onsets, 8 vowels, 4 codas; endings of female, male, other given names, and surnames, 8 each.
SOUNDS = {
    "Latin": ("b c d f g h j k l m n p r s t v".split(), "a e i o u a e i".split(), ["", "n", "l", "r"], {"f": "a ia ina ella ea etta isa ona".split(), "m": "us o or ian ek ard in os".split(), "n": "is en y el e ez ax im".split(), "s": "er man son ini ez ard sen ton".split()}),
    "Cyrillic": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у а е и".split(), ["", "н", "л", "р"], {"f": "а ия ина елла ея етта иса она".split(), "m": "ус ор иан ек ард ин ос ан".split(), "n": "ис ен ель ез акс им ет ул".split(), "s": "ов ев ин ский енко ер сон ман".split()}),
    "Greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ ψ".split(), "α ε ι ο υ α ε ι".split(), ["", "ν", "λ", "ρ"], {"f": "α ια ινα ελλα εα ιδα ισα ονα".split(), "m": "ος ης ας ων ιος ευς ιας ορας".split(), "n": "ις εν ελ υς αξ ιμ ετ ουλ".split(), "s": "ου ης ιδης οπουλος ακης ελης ας ος".split()}),
}
#: Syllables of a generated name at the first attempt; a later one has two more.
SYLLABLES = 3
#: Entities that may need another attempt: they travel with the plan.
MAX_RETRIES = 100_000
#: First day, and number of days (a prime), in which dates of birth are moved.
FIRST_DAY, DAYS = "1900-01-01", 47017


#: Letters that stand for one another, lower case: a surrogate keeps digits, vowels, consonants, accents and script.
ALPHABETS = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áàâäãåéèêëíìîïóòôöõúùûü", "çñšžčřďťğş")


def shift(text: Column, digest: Column) -> Column:
    """Moves each character within its alphabet by an amount from ``digest``; case, and what is in no alphabet, stay."""

    def placed(v: Column) -> Column:
        out = v["c"]
        for letters in ALPHABETS:
            at = F.instr(F.lit(letters), v["low"])
            new = F.substr(F.lit(letters), (at - 1 + v["by"]) % len(letters) + 1, F.lit(1))
            out = F.when((at > 0) & (v["low"] != ""), F.when(v["c"] == v["low"], new).otherwise(F.upper(new))).otherwise(out)
        return out

    def moved(digest: Column) -> Column:
        by = lambda i: F.conv(F.substr(digest, (i * 2) % 60 + 1, F.lit(2)), 16, 10).cast("int")
        return F.array_join(F.transform(F.split(text, ""), lambda c, i: let(F.struct(c.alias("c"), F.lower(c).alias("low"), by(i).alias("by")), placed)), "")

    return let(digest, moved)


def permuted(parts: Column, key: str) -> Column:
    """For an array of ``(text, tweak, tail)``: a keyed one-to-one map of the texts of one shape, then the tail.

    Four Feistel rounds, each half moved by a digest of the other. Upper and lower case of a text get the same surrogate
    but for case, so equal entities stay equal; as the map is one-to-one, different entities of a kind never share a
    surrogate. A null tweak leaves the text as it is.
    """

    def one(p: Column) -> Column:
        half = F.floor(F.length(p["text"]) / 2).cast("int")
        start = F.struct(F.substr(p["text"], F.lit(1), half).alias("l"), F.substr(p["text"], half + 1, F.length(p["text"])).alias("r"))

        def turn(v: Column, n: Column) -> Column:
            left = n % 2 == 0
            moved = shift(F.when(left, v["l"]).otherwise(v["r"]), F.sha2(F.concat_ws("|", F.lit(key), p["tweak"], n.cast("string"), F.lower(F.when(left, v["r"]).otherwise(v["l"]))), 256))
            return let(moved, lambda m: F.struct(F.when(left, m).otherwise(v["l"]).alias("l"), F.when(left, v["r"]).otherwise(m).alias("r")))

        return F.when(p["tweak"].isNull(), F.concat(p["text"], p["tail"])).otherwise(F.aggregate(F.sequence(F.lit(0), F.lit(3)), start, turn, lambda v: F.concat(v["l"], v["r"], p["tail"])))

    return F.transform(parts, one)


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def respell(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced in order by ``digits``, which are as many."""

    def put(c: Column, i: Column) -> Column:
        left = F.length(digits_of(F.substr(text, i + 1, F.length(text))))
        return F.when(c.rlike("^[0-9]$"), F.substr(digits, F.length(digits) - left + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), put), "")


def luhn(digits: Column) -> Column:
    """The check digit that a card number starting with ``digits`` has."""
    doubled = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return (10 - F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10) % 10


def _ip(t: Column, key: str, attempt: Column) -> Column:
    """The first number, which tells private from public, stays; the others are moved in turn by digests of the rest."""
    n = lambda v, i: F.get(v, F.lit(i))
    by = lambda k, *x: F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(f"{key}|ip{k}"), attempt, *[y.cast("string") for y in x]), 256), 1, 4), 16, 10).cast("int")
    v = F.transform(F.split(t, r"\."), lambda x: x.cast("int"))
    for k in range(2):
        v = let(v, lambda v, k=k: F.array(n(v, 0), (n(v, 1) + by(3 * k, n(v, 0), n(v, 2), n(v, 3))) % 256, n(v, 2), n(v, 3)))
        v = let(v, lambda v, k=k: F.array(n(v, 0), n(v, 1), (n(v, 2) + by(3 * k + 1, n(v, 0), n(v, 1), n(v, 3))) % 256, n(v, 3)))
        v = let(v, lambda v, k=k: F.array(n(v, 0), n(v, 1), n(v, 2), (n(v, 3) + by(3 * k + 2, n(v, 0), n(v, 1), n(v, 2))) % 256))
    return F.array_join(F.transform(v, lambda x: x.cast("string")), ".")


def _part(text: Column, tweak: Column | str | None, tail: Column | str = "") -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x).cast("string")
    return F.struct(text.alias("text"), lit(tweak).alias("tweak"), lit(tail).alias("tail"))


def _number(hexes: Column, at: int, width: int, n: int) -> Column:
    return (F.conv(F.substring(hexes, at, width), 16, 10).cast("long") % n).cast("int")


def coined(word: Column, tag: Column, attempt: Column, key: str) -> Column:
    """A name for one word of a name, by a keyed digest: its script, gender or surname form, case and hyphens stay.

    ``tag``: f, m or n for given names, s for surnames. The same word and tag give the same name in any case. Letters
    of scripts without sounds of their own get Latin names.
    """

    lists = lambda xs: F.split(F.lit(" ".join(x or "-" for x in xs)), " ")

    def sounds(w: Column) -> Column:
        out = None
        for script, (onsets, vowels, codas, endings) in reversed(SOUNDS.items()):
            own = F.struct(lists(onsets).alias("onset"), lists(vowels).alias("vowel"), lists(codas).alias("coda"), *[lists(endings[t]).alias(t) for t in "fmns"])
            out = own if out is None else F.when(w.rlike(rf"^\p{{Is{script}}}"), own).otherwise(out)
        return F.when(w.rlike(r"^\p{IsLatin}") | ~w.rlike(r"^[\p{IsCyrillic}\p{IsGreek}]"), F.struct(*[lists(x).alias(n) for n, x in zip(("onset", "vowel", "coda"), SOUNDS["Latin"][:3])], *[lists(SOUNDS["Latin"][3][t]).alias(t) for t in "fmns"])).otherwise(out)

    def part(w: Column) -> Column:
        def named(v: Column) -> Column:
            pick = lambda xs, at: F.replace(F.element_at(xs, F.pmod(F.get(v["d"], F.lit(at)), F.size(xs)) + 1), F.lit("-"), F.lit(""))
            syllable = lambda i: F.concat(*[pick(v["s"][n], 3 * i + k) for k, n in enumerate(("onset", "vowel", "coda"))])
            ending = F.when(tag == "f", v["s"]["f"]).when(tag == "m", v["s"]["m"]).when(tag == "n", v["s"]["n"]).otherwise(v["s"]["s"])
            more = F.when(attempt > 0, F.concat(syllable(4), syllable(5))).otherwise("")
            # an onset stands before the ending, so that no vowel does
            return F.concat(more, *[syllable(i) for i in range(SYLLABLES - 1)], pick(v["s"]["onset"], 18), pick(ending, 19))

        cased = lambda made: F.when((F.upper(w) == w) & (F.length(w) > 1), F.upper(made)).when(w.rlike(r"^\p{Lu}"), F.initcap(made)).otherwise(made)
        digest = F.sha2(F.concat_ws("|", F.lit(key), tag, attempt.cast("string"), F.lower(w)), 256)
        bytes_ = let(digest, lambda d: F.transform(F.sequence(F.lit(1), F.lit(61), F.lit(3)), lambda i: F.conv(F.substr(d, i, F.lit(3)), 16, 10).cast("int")))
        return F.when(w.rlike(r"^[-'’]$"), w).otherwise(let(let(F.struct(bytes_.alias("d"), sounds(w).alias("s")), named), cased))

    return F.array_join(F.transform(F.regexp_extract_all(word, F.lit(r"[-'’]|[^-'’]+"), F.lit(0)), part), "")


def stem(word: Column) -> Column:
    """A name's word without the possessive."""
    return F.regexp_replace(word, "['’]s$", "")


def _parts(v: Column) -> Column:
    """What of a match is permuted, and what stays.

    Email: the reserved ``example`` domains and the last label stay. Numbers: the first digit stays, a phone's country
    code, and a card's last digit, which is set afterwards; of an IBAN the country and the check digits.
    """
    labels = F.split(F.substring_index(v["match"], "@", -1), r"\.")
    kept = F.when(v["match"].rlike(r"[@.]example\.(?:com|org|net)$"), 2).otherwise(1)
    hosts = F.transform(labels, lambda x, i: _part(x, F.when(i < F.size(labels) - kept, F.concat(F.lit("host"), v["try"]))))
    email = F.concat(F.array(_part(F.substring_index(v["match"], "@", 1), F.concat(F.lit("email"), v["try"]))), hosts)
    iban = F.array(_part(F.substring(v["match"], 1, 4), None), _part(F.lower(F.regexp_replace(F.substring(v["match"], 5, 60), " ", "")), F.concat(F.lit("iban"), F.substring(v["match"], 1, 2), v["try"])))
    d, n = v["digits"], F.length(v["digits"])
    keep = F.when((v["kind"] == "phone") & home(d), n - 9).when(v["kind"] == "phone", F.lit(3)).otherwise(1)
    drop = F.when(v["kind"] == "card", 1).otherwise(0)
    number = F.array(_part(F.substr(d, F.lit(1), keep), None), _part(F.substr(d, keep + 1, n - keep - drop), F.concat(v["kind"], v["try"])))
    return F.when(v["kind"] == "email", email).when(v["kind"] == "iban", iban).otherwise(number)


def home(digits: Column) -> Column:
    """Ten digits, or eleven with a leading 1: one number with and without its country code."""
    return (F.length(digits) == 10) | ((F.length(digits) == 11) & digits.startswith("1"))


def mod97(text: Column) -> Column:
    """The remainder by which IBANs are checked; letters count from 10 on."""
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.upper(c)) - 1
    return F.aggregate(F.split(text, ""), F.lit(0), lambda s, c: let(value(c), lambda x: F.when(x > 9, s * 100 + x).otherwise(s * 10 + x)) % 97)


def respell_all(text: Column, letters: Column) -> Column:
    """``text`` with all but its spaces replaced in order by ``letters``."""

    def put(c: Column, i: Column) -> Column:
        before = F.length(F.replace(F.substr(text, F.lit(1), i), F.lit(" "), F.lit("")))
        return F.when(c == " ", c).otherwise(F.substr(letters, before + 1, F.lit(1)))

    return F.array_join(F.transform(F.split(text, ""), put), "")


def _iban(match: Column, new: Column) -> Column:
    """Country, check digits that are right if they were, and the rest as permuted; spaces stay."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    country, rest = F.substring(plain, 1, 2), F.upper(F.substring(new, 5, 60))
    right = lambda bban: 98 - mod97(F.concat(bban, country, F.lit("00")))
    off = F.substring(plain, 3, 2).cast("int") - right(F.substring(plain, 5, 60))
    return respell_all(match, F.concat(country, F.lpad(F.pmod(right(rest) + off, F.lit(97)).cast("string"), 2, "0"), rest))


def _day(match: Column) -> Column:
    iso = F.concat_ws("-", F.substring(match, 7, 4), F.substring(match, 4, 2), F.substring(match, 1, 2))
    return F.try_to_date(F.when(match.rlike("^\\d{4}-"), match).otherwise(iso), "yyyy-MM-dd")


def _birth(match: Column, attempt: Column, key: str) -> Column:
    """Another day, by a keyed one-to-one map of the days in question, in the same form; no day, or one outside, stays."""
    d = F.sha2(F.concat_ws("|", F.lit(key), F.lit("birth"), attempt), 256)
    at = F.datediff(_day(match), F.lit(FIRST_DAY).cast("date")).cast("long")
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(at * (_number(d, 1, 7, DAYS - 2) + 2) + _number(d, 9, 7, DAYS), F.lit(DAYS)).cast("int"))
    shape = lambda sep: F.concat_ws(sep, F.date_format(new, "dd"), F.date_format(new, "MM"), F.date_format(new, "yyyy"))
    made = F.when(match.rlike("^\\d{4}-"), F.date_format(new, "yyyy-MM-dd")).when(match.contains("/"), shape("/")).otherwise(shape("."))
    return F.when((at >= 0) & (at < DAYS), made).otherwise(match)


def surrogate(match: Column, kind: Column, tags: Column, attempts: Column, key: str) -> Column:
    """The entity's surrogate in the form of this match.

    ``tags``: map from the lower-case words of names in the document to their tags. ``attempts``: map from an entity to
    the attempt that gives its surrogate, where that is not the first. Of a card or an IBAN, it stays as it was
    whether check digits are right.
    """
    tried = lambda entity: F.coalesce(F.element_at(attempts, entity), F.lit(0))

    def built(v: Column) -> Column:
        join = lambda sep: F.array_join(v["new"], sep)
        off = F.substring(v["digits"], -1, 1).cast("int") - luhn(F.substr(v["digits"], F.lit(1), F.length(v["digits"]) - 1))
        number = let(join(""), lambda new: F.when(v["kind"] == "card", F.concat(new, F.pmod(luhn(new) + off, F.lit(10)).cast("string"))).otherwise(new))
        email = F.concat(F.get(v["new"], F.lit(0)), F.lit("@"), F.array_join(F.slice(v["new"], 2, F.size(v["new"])), "."))
        return F.when(v["kind"] == "email", email).when(v["kind"] == "iban", _iban(v["match"], join(""))).otherwise(let(number, lambda x: respell(v["match"], x)))

    def word(w: Column, tag: Column) -> Column:
        return F.when(tag == "t", w).otherwise(let(stem(w), lambda s: F.concat(coined(s, tag, tried(F.concat_ws(":", F.lit("name"), tag, F.lower(s))), key), F.substr(w, F.length(s) + 1, F.length(w)))))

    def person(m: Column) -> Column:
        tagged = lambda w: F.coalesce(F.element_at(tags, F.lower(stem(w))), F.lit("s"))
        own = titled_tags(m)
        return F.array_join(F.transform(F.split(m, " "), lambda w, i: F.when(kind == "name", word(w, tagged(w))).when(i == 0, w).otherwise(word(w, F.element_at(own, i)))), " ")

    given = F.struct(match.alias("match"), kind.alias("kind"), digits_of(match).alias("digits"), tried(F.concat_ws(":", kind, normal(match, kind))).cast("string").alias("try"))

    def other(v: Column) -> Column:
        moved = let(F.struct(v["match"].alias("match"), v["kind"].alias("kind"), v["digits"].alias("digits"), permuted(_parts(v), key).alias("new")), built)
        return F.when(v["kind"] == "ip", _ip(v["match"], key, v["try"])).when(v["kind"] == "birth", _birth(v["match"], v["try"], key)).otherwise(moved)

    return F.when(kind.isin("person", "name"), person(match)).otherwise(let(given, other))


def titled_tags(match: Column) -> Column:
    """Tags of the words after a title: given names have its gender (that of the first title which tells one), the last word is the
    surname, and further titles (``t``) stay."""
    gendered = lambda g: match.rlike(rf"^(?:{TITLE}\x20)*(?:{TITLES[g]})\b\.?\x20")
    gender = F.when(gendered("m"), "m").when(gendered("f"), "f").otherwise("n")
    words = F.slice(F.split(match, " "), 2, 9)
    last = F.size(words)
    return F.transform(words, lambda w, i: F.when((i + 1 < last) & w.rlike(f"^{TITLE}$"), "t").when(i + 1 == last, "s").otherwise(gender))


def kind_of(match: Column) -> Column:
    out = F.lit("name")
    for kind, pattern in reversed(KINDS[:-1]):
        out = F.when(match.rlike(pattern), kind).otherwise(out)
    return out


def normal(match: Column, kind: Column) -> Column:
    """What makes two mentions one entity: digits of numbers (the last ten of a home phone), days, letters without regard to case."""
    digits = digits_of(match)
    phone = F.when(home(digits), F.substring(digits, -10, 10)).otherwise(digits)
    return F.when(kind == "phone", phone).when(kind.isin("ssn", "card"), digits).when(kind == "iban", F.replace(match, F.lit(" "), F.lit(""))).when(kind == "birth", F.coalesce(_day(match).cast("string"), match)).otherwise(F.lower(match))


def no_attempts() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))


def _context(text: Column) -> Column:
    """``(pattern, tags)`` of a text: where it names persons by title, the words of their names are entities too."""
    persons = F.filter(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), lambda m: kind_of(m) == "person")
    words = F.flatten(F.transform(persons, lambda m: F.zip_with(F.slice(F.split(m, " "), 2, 9), titled_tags(m), lambda w, t: F.struct(stem(w).alias("word"), t.alias("tag")))))
    words = F.filter(words, lambda x: x["tag"] != "t")

    def built(w: Column) -> Column:
        spelled = F.array_distinct(F.transform(w, lambda x: x["word"]))
        first = F.array_distinct(F.transform(spelled, F.lower))
        tags = F.map_from_arrays(first, F.transform(first, lambda x: F.element_at(F.filter(w, lambda y: F.lower(y["word"]) == x), 1)["tag"]))
        quoted = F.array_join(F.transform(spelled, lambda x: F.concat(F.lit("\\Q"), x, F.lit("\\E"))), "|")
        pattern = F.when(F.size(w) == 0, F.lit(ENTITY)).otherwise(F.concat(F.lit(ENTITY + r"|(?<![\p{L}\p{M}])(?:"), quoted, F.lit(r")(?:['’]s)?(?![\p{L}\p{M}])")))
        return F.struct(pattern.alias("pattern"), tags.alias("tags"))

    return let(words, built)


def found_in(text: Column, context: Column, attempts: Column, key: str) -> Column:
    """Array of ``(kind, match, new)`` of a text, in order."""
    kinds = F.transform(F.regexp_extract_all(text, context["pattern"], F.lit(0)), lambda m: F.struct(m.alias("match"), kind_of(m).alias("kind")))
    return F.transform(kinds, lambda v: F.struct(v["kind"].alias("kind"), v["match"].alias("match"), surrogate(v["match"], v["kind"], context["tags"], attempts, key).alias("new")))


def rewritten(text: Column, pattern: Column, new: Column) -> Column:
    """``text`` with its entities replaced by ``new``, in order."""
    gaps = F.split(text, pattern, -1)
    return let(F.struct(gaps.alias("g"), new.alias("n")), lambda v: F.concat(F.array_join(F.zip_with(F.slice(v["g"], 1, F.size(v["n"])), v["n"], lambda a, b: F.concat(a, b)), ""), F.element_at(v["g"], -1)))


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(kind, match)``: different entities of the texts, names word by word with their tag in front (``f:Anna``)."""
    text = F.col(text_col).cast("string")
    matches = docs.where(text.rlike(ENTITY)).select(F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))).alias("match"))
    matches = matches.withColumn("kind", kind_of(F.col("match")))
    names = matches.where("kind = 'person'").select(F.explode(F.zip_with(F.slice(F.split("match", " "), 2, 9), titled_tags(F.col("match")), lambda w, t: F.concat_ws(":", t, stem(w)))).alias("match"))
    names = names.where("match not like 't:%'").groupBy(F.lower("match").alias("entity")).agg(F.min("match").alias("match")).select(F.lit("name").alias("kind"), "entity", "match")
    others = matches.where("kind <> 'person'").groupBy("kind", normal(F.col("match"), F.col("kind")).alias("entity")).agg(F.min("match").alias("match"))
    return names.unionByName(others.select("kind", "entity", "match"))


def surrogates(found: DataFrame, attempts: Column, key: str) -> DataFrame:
    """``found`` of ``entities`` with ``new``, the surrogate, and ``made``, what makes it one entity."""
    tag, word = F.substring_index("match", ":", 1), F.substring_index("match", ":", -1)
    name = F.col("kind") == "name"
    new = F.when(name, coined(word, tag, F.coalesce(F.element_at(attempts, F.concat_ws(":", "kind", "entity")), F.lit(0)), key)).otherwise(surrogate(F.col("match"), F.col("kind"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), attempts, key))
    # written, so that the optimizer does not repeat the long expression in what uses it
    return cut(found.withColumn("new", new)).withColumn("made", F.when(name, F.concat_ws(":", tag, F.lower("new"))).otherwise(normal(F.col("new"), F.col("kind"))))


def clashes(found: DataFrame, attempts: Column, key: str) -> DataFrame:
    """``(kind, entity)`` whose surrogate is another one's too (all but the first of them), its own original, or for coined names a real
    name of the corpus. Numbers, addresses and days go through permutations, which keep entities apart though a surrogate may be
    a real one: in a corpus that holds most of a kind's values no others are left."""
    made = surrogates(found, attempts, key).where("made is not null")
    order = F.row_number().over(Window.partitionBy("kind", "made").orderBy("entity"))
    made = cut(made.select("kind", "entity", "made", order.alias("turn")))
    word = lambda c: F.when(F.col("kind") == "name", F.substring_index(c, ":", -1)).otherwise(F.col(c))
    real = found.where("kind = 'name'").select(word("entity").alias("made_word")).distinct()
    taken = made.where("kind = 'name'").withColumn("made_word", word("made")).join(real, "made_word").select("kind", "entity")
    wrong = (F.col("turn") > 1) | ((F.col("kind") != "name") & (F.col("made") == F.col("entity")))
    return made.where(wrong).select("kind", "entity").unionByName(taken).distinct()


def settled(found: DataFrame, key: str, rounds: int = 24) -> Column:
    """Map from entities to the attempt that gives their surrogate, where that is not the first: repeated until none clashes.

    Clashes are few (chance equals): more than ``MAX_RETRIES`` are an error, as the map travels with the plan.
    """
    tries: dict[str, int] = {}
    for _ in range(rounds):
        attempts = F.map_from_arrays(F.array(*map(F.lit, tries)), F.array(*map(F.lit, tries.values()))) if tries else no_attempts()
        wrong = clashes(found, attempts, key).limit(MAX_RETRIES + 1).collect()
        if not wrong:
            return attempts
        for r in wrong:
            name = f"{r['kind']}:{r['entity']}"
            tries[name] = tries.get(name, 0) + 1
        if len(tries) > MAX_RETRIES:
            raise ValueError(f"more than {MAX_RETRIES} entities have clashing surrogates")
    raise ValueError(f"surrogates of {len(wrong)} entities still clash after {rounds} attempts, such as {wrong[0]}")


def with_surrogates(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the text rewritten, and ``pii_kinds``: the kinds of the entities replaced, in order.

    Emails, numbers and dates of birth go through keyed one-to-one maps; words of names get coined names of their
    gender (by the title) and script. Where a title names a person, the words of the name are replaced in the rest of
    that text too, with or without title or possessive. An entity has one surrogate in the whole corpus, under one key. First the
    different entities are gathered and their surrogates checked: where one equals another, its original or, for
    names, a real one of the corpus, that entity takes another attempt; only these travel with the plan. Then each task rewrites
    its rows alone. Null and empty texts stay as they are, with no entities; texts without any are untouched, and very
    long ones are worked on whole. Repeated rows are rewritten alike. An empty table gives an empty result. A column
    named ``pii_kinds`` is replaced, all others are kept.
    """
    attempts = settled(cut(entities(docs, text_col)), key)
    text = F.col(text_col).cast("string")

    def done(context: Column) -> Column:
        found = found_in(text, context, attempts, key)
        return let(found, lambda e: F.struct(rewritten(text, context["pattern"], F.transform(e, lambda x: x["new"])).alias("text"), F.transform(e, lambda x: x["kind"]).alias("kinds")))

    none = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    made = F.when(text.rlike(ENTITY), let(_context(text), done)).otherwise(none)
    columns = [c for c in docs.columns if c != "pii_kinds"]
    names = {c: f"_in{i}" for i, c in enumerate(columns)}
    out = docs.select(*[F.col(c).alias(n) for c, n in names.items()], made.alias("_done"))
    return out.select(*[(F.col("_done.text") if c == text_col else F.col(n)).alias(c) for c, n in names.items()], F.col("_done.kinds").alias("pii_kinds"))


#: The key of the query; a user gives their own and keeps it secret.
KEY = "surrogates-of-the-query"


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with surrogates; edge cases as in ``with_surrogates``."""
    out = with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)
    return out.select("doc_id", "text", F.size("pii_kinds").cast("long").alias("n_entities"), F.array_join("pii_kinds", ",").alias("kinds"))
