"""Row-local predicates and formats, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that the speech model invents in silence.
HALLUCINATIONS = (
    r"[Рр]едактор субтитров",
    r"[Кк]орректор\s+[А-Я]\.",
    r"[Сс]убтитры\s+(сделан|создан|выполнен|подготовлен)",
    r"[Сс]убтитры?\s+[Пп]еревод",
    r"[Пп]одготовлено.*субтитр",
    r"[Пп]одписывайтесь на канал",
    r"[Сс]пасибо за (просмотр|подписку|внимание)",
    r"[Дд]о новых встреч",
    r"[Дд]о следующего (выпуска|видео|эфира)",
    r"[Нн]е забудьте подписаться",
    r"[Сс]тавьте лайк",
    r"DimaTorzok",
    r"[Пп]родолжение следует",
    r"[Уу]читель и учени\w* обсуждают",
    r"обсуждают задачи",
    r"решают примеры вместе",
    r"[Уу]рок продолжается",
    r"[Уу]чебный процесс",
    r"[Оо]ни (работают|решают|обсуждают|разбирают)",
    r"[Рр]ечь академическая",
    r"[Вв]озможны термины из",
    r"[Оо]нлайн.?урок с репетитором",
    r"[Уу]читель объясняет материал",
    r"[Уу]ченик задаёт вопросы",
    r"[Рр]асшифровка.*урок",
    r"^\.+$",
    r"^\s*\.{2,}\s*$",
    r"^[\s\.\,\!\?\-\_]+$",
    r"^\s*Музыка\s*$",
    r"^\s*♪",
    r"^\[музыка\]$",
    r"^\[аплодисменты\]$",
    r"^\[смех\]$",
)
# Words that are answers by themselves.
RESPONSES = (
    "нет", "да", "угу", "ага", "так", "верно", "точно", "понятно", "неа",
    "один", "два", "три", "четыре", "пять", "шесть", "семь", "восемь", "девять", "десять", "ноль",
    "хорошо", "ладно", "правильно", "окей", "стоп", "ну",
)


#: Unicode White_Space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(c, F.lit(WHITE))


def _beginning(pattern: str) -> str | None:
    """The characters one of which a match begins with, as far as the pattern shows them plainly."""
    if pattern[0] == "[" and "]" in pattern and "\\" not in pattern.split("]")[0] and "^" not in pattern.split("]")[0]:
        return pattern[1 : pattern.index("]")] if pattern.split("]")[1][:1] not in ("?", "*", "{") else None
    return pattern[0] if pattern[0].isalpha() and pattern[1:2] not in ("?", "*", "{", "|") else None


def any_of(patterns) -> str:
    """One alternation of the patterns. Those that can begin with few characters only are tried just there."""
    begins = {p: None if "|" in re.sub(r"\([^()]*\)", "", p) else _beginning(p) for p in patterns}
    plain = [p for p in patterns if begins[p]]
    parts = [f"(?:{p})" for p in patterns if not begins[p]]
    if plain:
        letters = "".join(sorted(set("".join(begins[p] for p in plain))))
        parts.append(f"(?=[{letters}])(?:" + "|".join(f"(?:{p})" for p in plain) + ")")
    return "(?iuUd)" + "|".join(parts)


#: Cyrillic letters, and all characters that are one of the basic ones in another case.
CYRILLIC = "[\u0400-\u052f\u1c80-\u1c8f\ua640-\ua69f]"


def needs_cyrillic(pattern: str) -> bool:
    """Whether each match has a Cyrillic letter, as far as the pattern shows it plainly: one outside of groups, classes and options."""
    plain = re.sub(r"\\.", "", pattern)
    while re.search(r"\([^()]*\)", plain):
        plain = re.sub(r"\([^()]*\)[?*]?", "", plain)
    plain = re.sub(r".[?*{]", "", re.sub(r"\[[^\]]*\]", "", plain))
    return "|" not in plain and re.search("[\u0400-\u04ff]", plain) is not None


def is_hallucination(text: Column, patterns=HALLUCINATIONS) -> Column:
    """Blank, or one of the patterns is found (Unicode, case-insensitive). Texts without Cyrillic letters aren't searched for what needs some."""
    t = strip(F.coalesce(text, F.lit("")))
    cyrillic, others = [p for p in patterns if needs_cyrillic(p)], [p for p in patterns if not needs_cyrillic(p)]
    found = t == ""
    if others:
        found = found | t.rlike(any_of(others))
    if cyrillic:
        found = found | ((F.octet_length(t) > F.length(t)) & t.rlike(CYRILLIC) & t.rlike(any_of(cyrillic)))
    return found


def hallucination_reason(text: Column, avg_logprob: Column, no_speech_prob: Column) -> Column:
    lp, ns = F.coalesce(avg_logprob, F.lit(0.0)), F.coalesce(no_speech_prob, F.lit(0.0))
    low = F.format_string("low_logprob+no_speech (lp=%.2f ns=%.2f)", lp, ns)
    return F.when(is_hallucination(text), F.lit("pattern")).when((lp < -1.0) & (ns > 0.6), low)


def too_short(start: Column, end: Column, text: Column, no_speech_prob: Column, avg_logprob: Column) -> Column:
    doubtful = (F.coalesce(no_speech_prob, F.lit(0.0)) > 0.3) | (F.coalesce(avg_logprob, F.lit(0.0)) < -0.6)
    return (end - start < 0.3) & (F.length(strip(F.coalesce(text, F.lit("")))) <= 2) & doubtful


def mean_score(words: Column) -> Column:
    """Mean of the words' present scores; null without any."""
    none = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"))
    add = lambda a, s: F.struct((a["sum"] + F.coalesce(s, F.lit(0.0))).alias("sum"), (a["n"] + F.when(s.isNull(), 0).otherwise(1)).alias("n"))
    return F.aggregate(words["score"], none, add, lambda a: F.when(a["n"] > 0, a["sum"] / a["n"]))  # in one pass


def low_confidence_flag(avg_logprob: Column, words: Column, threshold: float = 0.45) -> Column:
    return F.when(F.coalesce(avg_logprob, F.lit(0.0)) < -0.8, F.lit("low_logprob")).when(
        (F.size(words) > 2) & (mean_score(words) < threshold), F.lit("low_confidence")
    )


def is_response_word(word: Column, before: Column | None = None) -> Column:
    """One of the answers (without ending .,!?), or the word before ends a question."""
    clean = F.rtrim(F.lower(strip(F.coalesce(word, F.lit("")))), F.lit(".,!?"))
    own = clean.isin(*RESPONSES)
    return own if before is None else own | F.coalesce(F.endswith(strip(before), F.lit("?")), F.lit(False))


def near_duplicate(a: Column, b: Column) -> Column:
    """Equal in lower case, or (both longer than 15) one holds the other at more than 0.8 of its length."""
    x, y = F.lower(a), F.lower(b)
    n, m = F.length(x), F.length(y)
    inside = F.when(n <= m, F.contains(y, x)).otherwise(F.contains(x, y))
    return (x == y) | ((n > 15) & (m > 15) & inside & (F.least(n, m) / F.greatest(n, m) > 0.8))


def punct_only(text: Column) -> Column:
    return strip(F.translate(text, ".,", "")) == ""


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda x: x != "")).cast("long")


def fmt_hms(seconds: Column) -> Column:
    s = F.greatest(F.lit(0), F.floor(seconds).cast("long"))
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def fmt_time(seconds: Column) -> Column:
    """HH:MM:SS.mmm"""
    ms = F.floor(seconds * 1000 % 1000)
    return F.format_string("%s.%03d", fmt_hms(seconds), ms)


def fmt_time_short(seconds: Column) -> Column:
    return fmt_hms(seconds)


def file_parts(path: Column) -> dict[str, Column]:
    """name, stem, ext (lower case, without the dot), folder."""
    name = F.substring_index(path, "/", -1)
    ext = F.lower(F.regexp_extract(name, r"^.+\.([^.]*)$", 1))
    return {
        "name": name,
        "stem": F.regexp_replace(name, r"^(.+)\.[^.]*$", "$1"),
        "ext": ext,
        "folder": F.regexp_replace(path, r"/?[^/]*$", ""),
    }


def error_clip(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)
