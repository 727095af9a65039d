"""Personal data: patterns propose, checksums confirm, context scores (operator 5).

Regular expressions propose spans of each kind (leftmost, not overlapping).
Validators confirm them: Luhn for cards, mod-97 for bank accounts (IBAN), value
ranges for addresses, digit counts for phones.  A span's score starts from its
kind and rises or falls with words near before it, in the text as it is; a
match that follows one of its kind as near shares the words of that one, so
that one word serves a whole list, unless a word of its own stands between.  Kinds without a checksum of their own stand
only with such a word.  A bank account is as long as its country has it.

Only DataFrame functions are used and nothing is shuffled.  A match is
marked in the text by a sign that no pattern can contain, and positions are
sums of the lengths between marks, so offsets count code points.  The patterns
cannot backtrack over long runs (possessive loops; a run is entered at its
start only).  Matches are walked in stretches of ``STRETCH``, so no list grows
match by match: the sums of the stretches say where each begins, and what is
carried from one match to the next.  Long texts with very many matches so cost
time about in proportion to both (tested).

Defined results: a null or empty text has no spans (counts 0, the hash of an
empty string, empty lists); rows that repeat are judged each; null ids pass
through; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: cheap test that a text can have a match
    hint: str
    #: SQL over ``x`` (the match)
    valid: str
    score: float
    #: words near before a match that raise or, in ``against``, lower its score
    context: str = ""
    needs_context: bool = False
    base: bool = False


def _digits(x: str = "x") -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


_MOD97 = ("aggregate(split(concat(substring(replace(x, ' ', ''), 5), substring(replace(x, ' ', ''), 1, 4)), ''), 0, "
          "(m, c) -> if(c between '0' and '9', (m * 10 + cast(c as int)) % 97, (m * 100 + ascii(c) - 55) % 97)) = 1")

#: Countries of the IBAN registry (and those that use its form) by the length of their numbers.
IBAN = {15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
        28: "AL AZ BF BJ BY CI CY DO EG FK GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR PS QA UA", 30: "JO KW MU YE",
        31: "MT SC", 32: "LC", 33: "RU"}
_IBAN = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN.items())

# The base kinds, in their listed order, then the method's own.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(t, '@')",
         "true", 0.8, "mail|contact|write|address", base=True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "contains(t, '.')",
         "forall(split(x, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)",
         0.6, "ip|host|server|address|login", base=True),
    Kind("card", r"(?<![0-9])(?=[0-9](?:[\x20-]?[0-9]){13})[0-9]++(?:[\x20-][0-9]++)*+", "true",
         f"length({_digits()}) between 14 and 19 and luhn_check({_digits()})", 0.8, "card|visa|credit|payment|amex", base=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "contains(t, '+')", f"length({_digits()}) between 10 and 15",
         0.7, "call|phone|tel|mobile|fax|contact", base=True),
    Kind("iban", rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})(?![A-Za-z0-9])", "true",
         _MOD97, 0.8, "iban|bank|account|konto"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "contains(t, '-')",
         "substring(x, 1, 3) not in ('000', '666') and substring(x, 1, 1) <> '9' and substring(x, 5, 2) <> '00' "
         "and substring(x, 8, 4) <> '0000'", 0.4, "ssn|social security", needs_context=True),
    Kind("secret", r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|[0-9a-f]{18,64})(?![A-Za-z0-9])", "true",
         "true", 0.4, "password|passwd|token|secret|api.?key|akia", needs_context=True),
)
AGAINST = "example|sample|version|isbn|test"
NEAR, STEP, BAR = 32, 0.2, 0.5
#: parts of a text that are walked at a time; even, so that a stretch begins with a gap
STRETCH = 256
_MARK, _OTHER = "\x01", "\x02"


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stretch(array: str, c: str = "c") -> str:
    return f"slice({array}, {c} * {STRETCH} + 1, {STRETCH})"


def _parts(k: Kind) -> str:
    """SQL for the text cut at the kind's matches: gaps and matches take turns, a match is every second part."""
    marked = f"regexp_replace(t, {_quoted('(' + k.pattern + ')')}, '{_MARK}$1{_MARK}')"
    return f"if({k.hint}, split({marked}, '{_MARK}', -1), cast(array() as array<string>))"


def _starts(parts: str) -> str:
    """SQL for where each stretch of ``parts`` begins in the text (and where the last one ends)."""
    sizes = f"transform(sequence(0, size({parts}) div {STRETCH}), c -> aggregate({_stretch(parts)}, 0, (n, x) -> n + length(x)))"
    return f"aggregate({sizes}, array(0), (a, n) -> concat(a, array(element_at(a, -1) + n)))"


def _spans(k: Kind, rank: int, parts: str, starts: str) -> str:
    """SQL for the array of (start, rank, kind, end, x, before) of a kind's valid matches."""
    kind = "struct<start: int, rank: int, kind: string, end: int, x: string, before: string>"
    # so many parts hold NEAR matches, which have NEAR signs at least
    back = 2 * NEAR
    tail = f"right(array_join(slice({parts}, greatest(c * {STRETCH} + 1 - {back}, 1), least({back}, c * {STRETCH})), ''), {NEAR})"
    walk = (f"aggregate({_stretch(parts)}, named_struct('at', at, 'odd', false, 'tail', {tail}, 'out', cast(array() as array<{kind}>)), "
            f"(a, x) -> named_struct('at', a.at + length(x), 'odd', not a.odd, 'tail', right(concat(a.tail, right(x, {NEAR})), {NEAR}), 'out', "
            f"if(a.odd and ({k.valid}), concat(a.out, array(named_struct('start', a.at, 'rank', {rank}, 'kind', '{k.name}', "
            "'end', a.at + length(x), 'x', x, 'before', a.tail))), a.out)), a -> a.out)")
    return f"flatten(transform({starts}, (at, c) -> {walk}))"


def _own(k: Kind, spans: str) -> str:
    """SQL for ``spans`` with ``plus`` and ``less``: a word that raises or lowers the score is near."""
    # what lies before the match before is that one's to tell
    before = f"lower(right(s.before, least({NEAR}, coalesce(s.start - get({spans}, i - 1).end, {NEAR}))))"
    near = f"concat({before}, lower(s.x))" if k.name == "secret" else before
    return (f"transform({spans}, (s, i) -> named_struct('start', s.start, 'rank', s.rank, 'kind', s.kind, 'end', s.end, 'x', s.x, "
            f"'plus', {f"rlike({near}, '{k.context}')" if k.context else 'false'}, 'less', rlike({before}, '{AGAINST}')))")


# a match as near as NEAR to the one before shares the words of that one, unless a word of its own stands between
_LINKED = f"not s.plus and s.start - a.end <= {NEAR}"
_TOLD = f"'end', s.end, 'plus', s.plus or (a.plus and {_LINKED}), 'less', s.less or (a.less and {_LINKED})"


def _carried(own: str) -> str:
    """SQL for what the match before each stretch of ``own`` hands on."""
    return (f"aggregate(sequence(0, size({own}) div {STRETCH}), array(named_struct('end', 0, 'plus', false, 'less', false)), "
            f"(b, c) -> concat(b, array(aggregate({_stretch(own)}, element_at(b, -1), (a, s) -> named_struct({_TOLD})))))")


def _told(own: str, carried: str) -> str:
    """SQL for ``own`` with what each match has from the one before."""
    kind = "struct<start: int, rank: int, kind: string, x: string, end: int, plus: boolean, less: boolean>"
    walk = (f"aggregate({_stretch(own)}, named_struct('end', b.end, 'plus', b.plus, 'less', b.less, 'out', cast(array() as array<{kind}>)), "
            f"(a, s) -> named_struct({_TOLD}, 'out', concat(a.out, array(named_struct('start', s.start, 'rank', s.rank, 'kind', s.kind, "
            f"'x', s.x, {_TOLD})))), a -> a.out)")
    return f"flatten(transform({carried}, (b, c) -> {walk}))"


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """One row per row of ``docs``: (doc_id, spans array<(start, rank, kind, end, text, score, base)>), by start and kind.

    Base kinds stand whatever their score; the others from a score of ``BAR``,
    those that need context only when it raises their score.
    """
    raw = F.coalesce(F.col(text_col), F.lit(""))
    t = F.when(F.contains(raw, F.lit(_MARK)), F.translate(raw, _MARK, _OTHER)).otherwise(raw)
    rows = docs.select(F.col(id_col).alias("doc_id"), t.alias("t"))
    names = [str(i) for i in range(len(kinds))]

    def step(made: dict[str, str], kept: list[str]) -> None:
        nonlocal rows
        rows = rows.selectExpr("doc_id", *kept, *(f"{sql} as {name}" for name, sql in made.items()))

    # each step reads the arrays of the last as columns: within a lambda, an expression would be made anew for every item
    step({f"p{i}": _parts(k) for i, k in enumerate(kinds)}, [])
    step({f"a{i}": _starts(f"p{i}") for i in names}, [f"p{i}" for i in names])
    step({f"k{i}": _spans(k, i, f"p{i}", f"a{i}") for i, k in enumerate(kinds)}, [])
    step({f"o{i}": _own(k, f"k{i}") for i, k in enumerate(kinds)}, [])
    step({f"c{i}": _carried(f"o{i}") for i in names}, [f"o{i}" for i in names])
    scored = []
    for i, k in enumerate(kinds):
        full = (f"transform({_told(f'o{i}', f'c{i}')}, s -> named_struct('start', s.start, 'rank', s.rank, 'kind', s.kind, 'end', s.end, "
                f"'text', s.x, 'score', cast(round({k.score} + if(s.plus, {STEP}, 0.0) - if(s.less, {STEP}, 0.0), 2) as double), 'base', {str(k.base).lower()}))")
        scored.append(full if k.base else f"filter({full}, s -> s.score >= {k.score + STEP / 2 if k.needs_context else BAR})")
    return rows.selectExpr("doc_id", f"array_sort(concat({', '.join(scored)})) as spans")


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind and of all, the hash of the base spans, and all spans as text, from what :func:`find` returns."""
    def listed(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"

    return found.selectExpr(
        "doc_id", *(f"cast(size(filter(spans, s -> s.kind = '{k.name}')) as long) as n_{k.name}" for k in KINDS),
        "cast(size(spans) as long) as n_any",
        f"sha2({listed('filter(spans, s -> s.base)')}, 256) as base_sha256", f"{listed('spans')} as spans",
        "array_join(transform(spans, s -> cast(s.score as string)), ',') as scores")
