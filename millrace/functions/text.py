"""Column functions over text, ids, dates and statuses. All are built-in expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Folded status labels.
ACTIVE, PARTIAL, FUTURE = "con hieu luc", "het hieu luc mot phan", "chua co hieu luc"
EXPIRED = "het hieu luc toan bo"




def _bare_letters() -> tuple[dict[str, str], dict[str, str]]:
    """What case folding and canonical decomposition leave of each character within ASCII: (one letter, several); derived."""
    one, more = {}, {}
    for c in (chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000):
        left = unicodedata.normalize("NFD", c.casefold()).encode("ascii", "ignore").decode()
        if left and left != c:
            (one if len(left) == 1 else more)[c] = left
    return one, more


BARE, BARE_MORE = _bare_letters()


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _folds() -> dict[str, str]:
    """Lower-case characters whose case folding is another single character; derived."""
    every = (chr(c) for c in range(0x80, 0x1E944) if not 0xD800 <= c < 0xE000)
    return {x: x.casefold() for x in every if x == x.lower() and x.casefold() != x and len(x.casefold()) == 1}


FOLDS = _folds()


def casefolded(text) -> Column:
    """Case folding: lower case, ß as ss and characters that fold to one other; ligatures and the like stay as they are."""
    return F.translate(F.replace(F.lower(col(text)), F.lit("ß"), F.lit("ss")), "".join(FOLDS), "".join(FOLDS.values()))


def tokens(text) -> Column:
    """Case-folded runs of letters, digits and underscores, in order, repeats included."""
    return F.regexp_extract_all(casefolded(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


#: Characters that case folding takes into or out of words, or into parts of them; texts without them needn't be folded to be counted.
UNLIKE = ("\u0130", "\u0345")


def token_count(text) -> Column:
    """How many ``tokens`` a text has; folded only where that can change the number."""
    odd = col(text).contains(UNLIKE[0]) | col(text).contains(UNLIKE[1])
    found = F.when(odd, casefolded(text)).otherwise(col(text))
    return F.regexp_count(found, F.lit(r"[\p{L}\p{N}_]+"))


def term_runs(terms) -> Column:
    """(term, tf) of each different term of an array of them, counted within the row: equal neighbours of the sorted array."""
    runs = F.regexp_extract_all(F.array_join(F.sort_array(terms), " "), F.lit(r"(?<!\S)(\S+)(?: \1(?!\S))*+"), F.lit(0))

    def counted(run):
        term = F.substring_index(run, " ", 1)
        return F.struct(term.alias("term"), ((F.char_length(run) + 1) / (F.char_length(term) + 1)).cast("long").alias("tf"))

    return F.transform(runs, counted)


def sha256_hex(*parts, sep: str = "|") -> Column:
    """SHA-256 of the parts joined by ``sep``; null parts are empty."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]).cast("binary"), 256)


def joined(sep: str, *parts) -> Column:
    """The parts that are neither null nor empty."""
    return F.concat_ws(sep, *[F.nullif(col(p), F.lit("")) for p in parts])


def stripped(text) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(col(text), r"(?U)^\s+|\s+$", "")


def source_date(value) -> Column:
    """The date that the first ten characters spell in an ISO form (calendar or week date, extended or basic), else null.

    Of ten characters, two may follow a whole basic form (the beginning of a time).
    """
    s = F.substring(col(value), 1, 10)
    year = F.left(s, F.lit(4)).try_cast("int")
    week = F.regexp_extract(s, r"^\d{4}-?W(\d{2})", 1).try_cast("int")
    day = F.coalesce(F.nullif(F.regexp_extract(s, r"^\d{4}-?W\d{2}-?(\d)", 1), F.lit("")).try_cast("int"), F.lit(1))
    monday = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))).cast("date")
    fits = week.between(1, F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))) & day.between(1, 7)
    return (
        F.when(s.startswith("0000"), F.lit(None).cast("date"))
        .when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd"))
        .when(s.rlike(r"(?s)^\d{8}(..)?$"), F.try_to_date(F.left(s, F.lit(8)), "yyyyMMdd"))
        .when(s.rlike(r"(?s)^\d{4}(-W\d{2}(-\d)?|W\d{2}(\d(..)?)?)$") & fits, F.date_add(monday, (week - 1) * 7 + day - 1))
    )


def or_unknown(value) -> Column:
    return F.coalesce(F.nullif(col(value), F.lit("")), F.lit("unknown"))


def folded(label) -> Column:
    """Case-folded and decomposed, without anything beyond ASCII: marks go, base letters stay, letters without one go."""
    bare = F.translate(col(label), "".join(BARE), "".join(BARE.values()))
    for several, left in BARE_MORE.items():  # ß and ligatures
        bare = F.replace(bare, F.lit(several), F.lit(left))
    return F.regexp_replace(bare, r"[^\x00-\x7F]", "")


def bucket_exact(label) -> Column:
    """Status bucket by equality of the folded label."""
    f = folded(label)
    return F.when(f == ACTIVE, "active").when(f == PARTIAL, "partially_expired").when(f == FUTURE, "future").otherwise("unclassified")


def bucket_contains(label) -> Column:
    """Status bucket by what the folded label contains, full expiry first; null labels are unclassified."""
    f = F.coalesce(folded(label), F.lit(""))
    return F.when(f.contains(EXPIRED), "expired").when(f.contains(PARTIAL), "partially_expired").when(f.contains(FUTURE), "future").when(f.contains(ACTIVE), "active").otherwise("unclassified")


def is_selected(label) -> Column:
    return folded(label).isin(ACTIVE, PARTIAL, FUTURE)


def length_bucket(n_bytes) -> Column:
    return F.when(col(n_bytes) < 10_000, "short").when(col(n_bytes) < 100_000, "medium").otherwise("long")


def first_line(text, most: int = 300) -> Column:
    return F.left(F.substring_index(col(text), "\n", 1), F.lit(most))


def slice_text(text, start, end) -> Column:
    """The code points from ``start`` up to ``end``."""
    return F.substring(col(text), col(start) + 1, col(end) - col(start))


def piece_starts(text, limit: int) -> Column:
    """Where pieces of at most ``limit`` characters begin; none for an empty or null text."""
    if limit < 1:
        raise ValueError("max_chars must be positive")
    n = F.char_length(col(text))
    return F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(limit))).otherwise(F.array().cast("array<int>"))


def pieces(text, limit: int) -> Column:
    """The pieces of at most ``limit`` characters in order, cut in one pass; none for an empty or null text."""
    if limit < 1:
        raise ValueError("max_chars must be positive")
    return F.coalesce(F.regexp_extract_all(col(text), F.lit(f"(?s).{{1,{limit}}}"), F.lit(0)), F.array().cast("array<string>"))


def origin(url) -> Column:
    """Scheme and authority in lower case."""
    return F.concat(F.lower(F.try_parse_url(col(url), F.lit("PROTOCOL"))), F.lit("://"), F.lower(F.try_parse_url(col(url), F.lit("AUTHORITY"))))


def is_https_of(url, base) -> Column:
    """Whether the URL is https and of the same origin."""
    return (F.lower(F.try_parse_url(col(url), F.lit("PROTOCOL"))) == "https") & (origin(url) == origin(base))


def from_template(template: str, value, mark: str = "{doc_id}") -> Column:
    return F.replace(F.lit(template), F.lit(mark), col(value).cast("string"))
