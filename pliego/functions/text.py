"""Text expressions on the JVM side: Unicode-aware patterns, windows, labels, title case, tokens.

All functions take and return Columns.  A null text gives null unless said otherwise.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, str, dict[str, str]]:
    """By rule, for each character what it folds to (full case folding, compatibility decomposition without combining
    marks): characters that become one other, what these are, those that vanish, and those that become several."""
    one, to, none, several = [], [], [], {}
    for c in map(chr, chain(range(0xD800), range(0xE000, 0x20000), range(0xE0000, 0xE1000))):
        f = "".join(x for x in unicodedata.normalize("NFKD", c.casefold()) if not unicodedata.combining(x))
        if len(f) == 1 and f != c:
            one.append(c), to.append(f)
        elif not f:
            none.append(c)
        elif len(f) > 1:
            several[c] = f
    return "".join(one), "".join(to), "".join(none), several


def _char_class(chars: list[str]) -> str:
    """A character class of sorted characters, by ranges."""
    out, first = [], None
    for c, following in zip(chars, [*chars[1:], None]):
        first = first or c
        if following is None or ord(following) != ord(c) + 1:
            out.append(rf"\x{{{ord(first):X}}}-\x{{{ord(c):X}}}")
            first = None
    return rf"[\x{{{ord(chars[0]):X}}}-\x{{10FFFF}}&&[" + "".join(out) + "]]"  # most characters are below all of them


def pattern(p: str, flags: str = "iuUd") -> str:
    """A pattern with Unicode classes and case folding, where . stops at line feeds only."""
    return f"(?{flags})" + p


def has(c: Column, p: str) -> Column:
    """Whether the pattern is found, without regard to case."""
    return c.rlike(pattern(p))


def group(c: Column, p: str, g: int = 1, flags: str = "iuUd") -> Column:
    """The group of the first match; null where nothing matches or the group is empty."""
    return F.nullif(F.regexp_extract(c, pattern(p, flags), g), F.lit(""))


def window_after(c: Column, p: str, n: int = 400) -> Column:
    """The n characters after the first match, "" without one."""
    return F.regexp_extract(c, pattern(f"(?:{p})(.{{0,{n}}})", "iusUd"), 1)


def label_line(c: Column, label: str) -> Column:
    """The line after "label...:", trimmed and without full stops at its end; null without one.  Case counts."""
    line = F.regexp_extract(c, pattern(f"(?:{label})[^\n]*:\n([^\n]+)", "uUd"), 1)
    return F.when(c.rlike(pattern(f"(?:{label})[^\n]*:\n[^\n]+", "uUd")), F.trim(F.regexp_replace(F.trim(line), r"\.+$", "")))


#: Ordinals that head sections (fixed value).
ORDINALS = "Primero|Segundo|Tercero|Cuarto"


def section(c: Column, title: str) -> Column:
    """What follows an ordinal heading with this title, on its line or else the next: 300 characters at most, null if empty.  Case counts."""
    p = pattern(rf"(?:{ORDINALS})\.?\s*-?\s*(?:{title})[.:]?\s*([^\n]*)\n([^\n]*)", "uUd")
    line = F.coalesce(F.nullif(F.regexp_extract(c, p, 1), F.lit("")), F.regexp_extract(c, p, 2))
    return F.nullif(F.left(F.trim(line), F.lit(300)), F.lit(""))


def first_match(c: Column, values: dict[str, str]) -> Column:
    """The value whose pattern matches earliest; of equal places the one listed first; null without a match."""
    places = F.array(*[F.struct(F.regexp_instr(c, F.lit(pattern(p))).alias("at"), F.lit(k).alias("rank"), F.lit(v).alias("value")) for k, (p, v) in enumerate(values.items())])
    return F.array_min(F.filter(places, lambda x: x["at"] > 0))["value"]


def title_case(c: Column) -> Column:
    """Every run of letters with a capital in front, the rest in lower case ("D'Art (Sevilla)")."""
    parts = F.regexp_extract_all(c, F.lit(r"(?U)\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.when(c.isNotNull(), F.concat_ws("", F.transform(parts, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, 2, 100000))))))


#: Words that stay small inside a title (fixed values).
SMALL = ("de", "del", "la", "las", "los", "el", "y", "e", "en", "para", "a", "al", "con", "por")


def title_case_es(c: Column) -> Column:
    """Every word with a capital in front except small words, the first word always."""
    words = F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda w: w != "")
    one = lambda w, k: F.when((k > 0) & w.isin(*SMALL), w).otherwise(F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 100000)))
    return F.array_join(F.transform(words, one), " ")


def format_string(c: Column) -> Column:
    """Trimmed, without commas at the end; what is all capitals and longer than 6 becomes a title."""
    s = F.trim(F.regexp_replace(F.trim(c), r"[,\s]+$", ""))
    return F.when((F.upper(s) == s) & s.rlike(r"\p{L}") & (F.length(s) > 6), title_case_es(s)).otherwise(s)


def fold(c: Column) -> Column:
    """Full case folding and compatibility decomposition without combining marks ("1ª" is "1a", "ﬁ" is "fi").

    One translation for characters that become one; only texts with a character that becomes several are
    taken apart, and only those characters are looked up.
    """
    one, to, none, several = _folds()
    plain = F.translate(c, one + none, to)
    kind = _char_class(sorted(several))
    table = F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in several.items())), F.lit("\x02"), F.lit("\x01"))
    spelled = F.array_join(F.transform(F.split(plain, ""), lambda x: F.when(x.rlike(kind), F.try_element_at(table, x)).otherwise(x)), "")
    return F.when(c.rlike(kind), spelled).otherwise(plain)


def tokens(c: Column) -> Column:
    """The folded words; null gives no words."""
    return F.coalesce(F.regexp_extract_all(fold(c), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), F.array().cast("array<string>"))


def let(columns: dict[str, Column], body) -> Column:
    """`body` of a struct of the columns, which are evaluated once however often body uses them (functions over arrays evaluate what isn't bound for each element)."""
    return F.transform(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])), body)[0]


def token_f1(a: Column, b: Column) -> Column:
    """Overlap of two texts' words as multisets, as an F1; 0 without common words."""
    times = lambda arr, w: F.size(F.filter(arr, lambda t: t == w))

    def overlap(v: Column) -> Column:
        common = F.aggregate(F.array_distinct(v["x"]), F.lit(0), lambda acc, w: acc + F.least(times(v["x"], w), times(v["y"], w)))
        return F.when(common == 0, F.lit(0.0)).otherwise(2.0 * common / (F.size(v["x"]) + F.size(v["y"])))

    return let({"x": tokens(a), "y": tokens(b)}, overlap)


def html_escape(c: Column) -> Column:
    out = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def html_text(c: Column) -> Column:
    """The text of HTML that needn't be well formed: no scripts, styles, comments and tags; blocks and breaks part lines; blank lines go."""
    t = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "")
    t = F.regexp_replace(t, r"(?i)</?(?:p|div|li|tr|h[1-6]|dt|dd|ul|ol|table|br)\b[^>]*>", "\n")
    t = F.regexp_replace(t, r"(?s)<[^>]+>", "")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    lines = F.transform(F.split(t, "\n"), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


#: Tokens of the default tokenizer: words and single marks, with the white space before them.
PIECE = r"[ \t\n\f\r]*(?:[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\f\r])"


def truncate_tokens(c: Column, most: int, piece: str = PIECE) -> Column:
    """The text up to the end of its token `most`; unchanged if it has no more tokens.  Null stays null."""
    pieces = F.regexp_extract_all(c, F.lit(piece), F.lit(0))
    # a text of so few characters has no more tokens
    return F.when(F.length(c) <= most, c).when(F.size(pieces) > most, F.array_join(F.slice(pieces, 1, most), "")).otherwise(c)


def try_int(c: Column) -> Column:
    """Digits as a number, anything else null."""
    return F.when(c.rlike(r"^[0-9]+$"), c.try_cast("int"))
