"""Format-preserving Feistel pseudonyms for personal data, in Spark SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried

ROUNDS = 10
#: Area numbers that are never given out.
_SSN = "{} rlike '^(?!000|666|9)'"
#: First and one-past-last day that a date is permuted within.
FIRST_DAY, DAYS = "1900-01-01", 73049

#: Usual forms of a card number; a looser one does not run into the start of such.
_CARD = r"(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{14,19})"
#: kind -> pattern of a whole value, most specific first. A value starts and ends at no letter or digit. That of an IBAN
#: is longer than one, so that it takes in whole what numbers follow it.
PATTERNS: dict[str, str] = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "aws_key": r"(?:AKIA|ASIA)[0-9A-Z]{16}",
    "token": r"(?:ghp_|gho_|sk-|xox[bp]-)[A-Za-z0-9-]{16,}",
    "password": r"(?i:password|passwd|pwd|secret|token|api_?key)[=:][^\s\"',;]+",
    "hex": r"[0-9a-f]{32,64}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,13}(?: ?[A-Z0-9]{1,3})?",
    "date": r"(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9]|[0-3][0-9]([./])[01][0-9]\1(?:19|20)[0-9]{2}|[01][0-9]/[0-3][0-9]/(?:19|20)[0-9]{2}",
    "ip": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}",
    "card": rf"[0-9](?:(?:[ -](?!{_CARD}(?![A-Za-z0-9])))?[0-9]){{12,18}}",
}
_ANY = r"(?<![A-Za-z0-9])(?:" + "|".join(PATTERNS.values()) + r")(?![A-Za-z0-9])"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def feistel(value: str, radix: int, tweak: str, key: str) -> str:
    """SQL of a keyed permutation of the strings of value's length over the digits of a radix (lower case).

    The two halves take turns: one is shifted by a keyed hash of the other, modulo its own number of strings. Halves have
    to stay below 10^15.
    """
    n = f"char_length({value})"
    u, v = f"(({n}) div 2)", f"({n} - ({n}) div 2)"
    number = lambda part: f"cast(coalesce(conv({part}, {radix}, 10), '0') as bigint)"
    digits = lambda x, size: f"lpad(lower(conv(cast({x} as string), 10, {radix})), cast({size} as int), '0')"
    hashed = f"cast(conv(substr(sha2(concat_ws('|', {_sql(key)}, {tweak}, {n}, i, s.b), 256), 1, 15), 16, 10) as bigint)"
    return (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('a', {number(f'substr({value}, 1, {u})')}, 'b', {number(f'substr({value}, {u} + 1)')}), "
        f"(s, i) -> named_struct('a', s.b, 'b', pmod(s.a + {hashed}, cast(pow({radix}, if(i % 2 = 1, {u}, {v})) as bigint))), "
        f"s -> concat({digits('s.a', u)}, {digits('s.b', v)}))"
    )


def _let(name: str, value: str, body: str) -> str:
    """body with `name` bound to value once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


#: Steps of a cycle walk at most: a chain of so many misses has a chance under 10^-20 even where a quarter of the range is inside.
STEPS = 170


def _walk(start: str, inside: str, step: str) -> str:
    """SQL: a permutation of the values `inside` a larger range: step again and again until one comes. Both are SQL of x."""
    return f"aggregate(sequence(1, {STEPS}), {start}, (x, i) -> if(i > 1 and {inside}, x, {step}))"


def _refill(shape: str, chars: str, digits: str) -> str:
    """shape with its characters of a class replaced, in order, by those of digits; upper case stays upper."""
    return (
        f"aggregate(split({shape}, ''), named_struct('out', '', 'k', 1), (s, c) -> if(c rlike '^{chars}$', "
        f"named_struct('out', concat(s.out, if(c rlike '[A-Z]', upper(substr({digits}, s.k, 1)), substr({digits}, s.k, 1))), 'k', s.k + 1), "
        "named_struct('out', concat(s.out, c), 'k', s.k)), s -> s.out)"
    )


def _parts(text: str, radix: int, tweak: str, key: str) -> str:
    """Strings of digits of a radix permuted 18 characters at a time; '' stays."""
    part = feistel("p", radix, f"concat({tweak}, j)", key)
    return f"array_join(transform(sequence(0, (char_length({text}) - 1) div 18), j -> {_let('p', f'substr({text}, j * 18 + 1, 18)', part)}), '')"


def _wide(shape: str, tweak: str, key: str) -> str:
    """Letters and digits of shape permuted as base-36 strings of up to 18 at a time."""
    return _let("w", f"lower(regexp_replace({shape}, '[^A-Za-z0-9]', ''))", f"if(w = '', {shape}, {_let('d', _parts('w', 36, tweak, key), _refill(shape, '[A-Za-z0-9]', 'd'))})")


#: The letters, and the digits of radix 26 that stand for them.
_LETTERS, _RADIX_26 = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"


def _placed(shape: str, tweak: str, key: str) -> str:
    """Digits of shape permuted among its digits' places, letters among its letters'."""
    digits = _let("w", f"regexp_replace({shape}, '[^0-9]', '')", f"if(w = '', {shape}, {_let('d', _parts('w', 10, tweak, key), _refill(shape, '[0-9]', 'd'))})")
    spelt = f"translate({_parts('v', 26, f"concat({tweak}, 'letters')", key)}, '{_RADIX_26}', '{_LETTERS}')"
    letters = _let("d", spelt, _refill("o", "[A-Za-z]", "d"))
    return _let("o", digits, _let("v", f"translate(lower(regexp_replace(o, '[^A-Za-z]', '')), '{_LETTERS}', '{_RADIX_26}')", f"if(v = '', o, {letters})"))


def _luhn(digits: str) -> str:
    """Sum of Luhn's digits, the last one counted singly."""
    return (
        f"aggregate(transform(split(reverse({digits}), ''), (c, k) -> if(k % 2 = 0, cast(c as int), (cast(c as int) * 2) div 10 + (cast(c as int) * 2) % 10)), 0L, (s, x) -> s + x)"
    )


def _mod97(text: str) -> str:
    """Remainder of an IBAN rearranged and spelt in digits."""
    spelt = f"split(concat(substr({text}, 5), substr({text}, 1, 4)), '')"
    return f"aggregate(transform({spelt}, c -> conv(c, 36, 10)), 0, (s, c) -> cast((s * if(char_length(c) = 2, 100, 10) + cast(c as int)) % 97 as int))"


def _inside(m: str, kinds: list[tuple[str, str, str, str]]) -> str:
    """SQL: struct(n, value) of a match whose n runs of groups that pass are replaced; the groups around them stay.

    kinds: (kind, usual form, check, value) each, check and value SQL of `x`. Of runs that overlap the earlier kind counts, then
    the usual form, the longer and the first.
    """
    at = lambda k: f"substr({m}, {k}, 1) rlike '[ -]'"
    starts = f"filter(sequence(1, char_length({m})), i -> i = 1 or {at('i - 1')})"
    ends = f"filter(sequence(1, char_length({m})), j -> j = char_length({m}) or {at('j + 1')})"
    runs = f"flatten(transform({starts}, i -> transform(filter({ends}, j -> j >= i), j -> named_struct('i', i, 'j', j, 'x', substr({m}, i, j - i + 1)))))"
    good = [
        f"transform(filter(filter(runs, w -> w.x rlike {_sql(f'^(?:{PATTERNS[kind]})$')}), w -> {_let('x', 'w.x', check)}), "
        f"w -> named_struct('k', {k}, 'u', w.x not rlike {_sql(f'^{usual}$')}, 'n', w.i - w.j, 'i', w.i, 'j', w.j, 'x', w.x))"
        for k, (kind, usual, check, _) in enumerate(kinds)
    ]
    best = "aggregate(good, slice(good, 1, 0), (kept, w) -> if(exists(kept, b -> b.i <= w.j and w.i <= b.j), kept, concat(kept, array(w))))"
    value = _let("x", "w.x", "case w.k " + " ".join(f"when {k} then {value}" for k, (*_, value) in enumerate(kinds)) + " end")
    ordered = "array_sort(transform(best, b -> named_struct('i', b.i, 'j', b.j, 'k', b.k, 'x', b.x)))"
    filled = f"aggregate({ordered}, named_struct('out', '', 'at', 1), (s, w) -> named_struct('out', concat(s.out, substr({m}, s.at, w.i - s.at), {value}), 'at', w.j + 1), s -> concat(s.out, substr({m}, s.at)))"
    return _let("runs", runs, _let("good", f"array_sort(concat({', '.join(good)}))", _let("best", best, f"named_struct('n', size(best), 'value', {filled})")))


def _pseudonym(m: str, key: str) -> str:
    """SQL: struct(n, value) of a match, n the values in it; 0 and the match itself where the check of its kind fails."""
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    is_ = lambda kind: f"{m} rlike {_sql('^(?:' + PATTERNS[kind] + ')$')}"
    got = lambda value: f"named_struct('n', 1, 'value', {value})"
    none = f"named_struct('n', 0, 'value', {m})"
    day = f"coalesce(try_to_date({m}, 'yyyy-MM-dd'), try_to_date({m}, 'dd.MM.yyyy'), try_to_date({m}, 'dd/MM/yyyy'), try_to_date({m}, 'MM/dd/yyyy'))"
    walk = feistel("lpad(cast(x as string), 5, '0')", 10, "'date'", key)
    # the days are a part of the five-digit numbers; those after the 12th, which alone read as month first, stay among
    # themselves in every format, so that a day has one pseudonym
    inside = f"x < {DAYS} and (day(date_add(date'{FIRST_DAY}', x)) > 12) = (day(y) > 12)"
    moved = _walk(f"datediff(y, date'{FIRST_DAY}')", inside, f"cast({walk} as int)")
    shown = f"date_format(date_add(date'{FIRST_DAY}', z), case when {m} rlike '-' then 'yyyy-MM-dd' when {m} rlike '/' then if(try_to_date({m}, 'dd/MM/yyyy') is null, 'MM/dd/yyyy', 'dd/MM/yyyy') else 'dd.MM.yyyy' end)"
    date = _let("y", day, f"if(y is null, {none}, {got(_let('z', moved, shown))})")
    octets = f"split({m}, '[.]')"
    address = f"array_join(transform({octets}, o -> lpad(lower(conv(o, 10, 16)), 2, '0')), '')"
    ip = _let("h", address, _let("g", feistel("h", 16, "'ip'", key), "array_join(transform(sequence(0, 3), k -> conv(substr(g, 2 * k + 1, 2), 16, 10)), '.')"))
    ssn = _let("h", digits, _let("g", _walk("h", _SSN.format("x"), feistel("x", 10, "'ssn'", key)), _refill(m, "[0-9]", "g")))
    only = "regexp_replace(x, '[^0-9]', '')"
    body = _let("h", f"substr({only}, 1, char_length({only}) - 1)", feistel("h", 10, "'card'", key))
    card = _let("g", body, _let("e", f"concat(g, cast(pmod(10 - {_luhn("concat(g, '0')")} % 10, 10) as string))", _refill("x", "[0-9]", "e")))
    # country and check digits lead; the account keeps its places of digits and of letters, the check digits are made anew
    plain = "upper(replace(x, ' ', ''))"
    account = _let("q", plain, _let("g", _placed("substr(q, 5)", "'iban'", key), _let("e", f"concat(substr(q, 1, 2), lpad(cast(98 - {_mod97("concat(substr(q, 1, 2), '00', g)")} as string), 2, '0'), g)", _refill("x", "[A-Za-z0-9]", "e"))))
    ibans = ("iban", ".*", f"char_length({plain}) <= 34 and {_mod97(plain)} = 1", account)
    cards = ("card", _CARD, f"{_luhn(only)} % 10 = 0", card)
    phone = f"concat(regexp_extract({m}, '^([+][0-9]{{1,3}}[ .-])?', 0), {_let('t', f'regexp_replace({m}, {_sql("^[+][0-9]{1,3}[ .-]")}, {_sql("")})', _let('h', "regexp_replace(t, '[^0-9]', '')", _let('g', feistel('h', 10, "'phone'", key), _refill('t', '[0-9]', 'g'))))})"
    at = f"locate('@', {m})"
    email = f"concat({_wide(f'substr({m}, 1, {at} - 1)', "'local'", key)}, '@', {_wide(f"substring_index(substr({m}, {at} + 1), '.', size(split(substr({m}, {at} + 1), '[.]')) - 1)", "'host'", key)}, '.', substring_index({m}, '.', -1))"
    secret = f"concat(regexp_extract({m}, '^[^=:]+[=:]', 0), {_wide(f"regexp_replace({m}, '^[^=:]+[=:]', '')", "'secret'", key)})"
    token = f"concat(regexp_extract({m}, '^(?:ghp_|gho_|sk-|xox[bp]-)', 0), {_wide(f"regexp_replace({m}, '^(?:ghp_|gho_|sk-|xox[bp]-)', '')", "'token'", key)})"
    hexed = f"array_join(transform(sequence(0, (char_length({m}) - 1) div 20), j -> {_let('p', f'substr({m}, j * 20 + 1, 20)', feistel('p', 16, "concat('hex', j)", key))}), '')"
    return (
        f"case when {is_('email')} then {got(email)} "
        f"when {is_('aws_key')} then {got(f"concat(substr({m}, 1, 4), upper({_wide(f'substr({m}, 5)', "'aws'", key)}))")} "
        f"when {is_('token')} then {got(token)} "
        f"when {is_('password')} then {got(secret)} "
        f"when {is_('hex')} then {got(hexed)} "
        f"when {is_('iban')} then {_inside(m, [ibans, cards])} "
        f"when {is_('date')} then {date} "
        f"when {is_('ip')} then if(forall({octets}, o -> cast(o as int) < 256), {got(ip)}, {none}) "
        f"when {is_('ssn')} then if({_SSN.format(m)}, {got(ssn)}, {none}) "
        f"when {is_('phone')} then {got(phone)} "
        f"when {is_('card')} then {_inside(m, [cards])} else {none} end"
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """docs with personal data in text replaced, n_chars (if there) set to the new length where something was, n_pii added (long).

    Numbers are replaced where their check holds: Luhn for cards, mod 97 for IBANs, octets for addresses, areas for social
    security numbers, the calendar for dates from 1900 to 2099 (the day first if both ways are dates; those that are dates only
    with the month first stay so). Where digits or groups stand beside card numbers or IBANs, every run of groups that passes is
    replaced, in an IBAN's match card numbers too; n_pii counts each. The pseudonym passes the same check in the same format: an
    IBAN keeps its country and its account's places of digits and of letters (national check digits inside an account are not
    made anew), and a day has one pseudonym in all its spellings. E-mails, phones, keys, tokens, passwords and long hex
    strings are permuted letter for letter, capitals staying capital where a letter stays a letter. Equal values, e-mails in
    any case, get equal pseudonyms in every document. Whoever has `key` can undo them, so it has no default.
    A null text stays null (n_pii 0); a text without matches is unchanged. Rows and other columns, of any name, are untouched;
    a column named n_pii is replaced.
    """
    out = docs.select(carried(docs).alias("own"), F.coalesce(F.col("text").rlike(_ANY), F.lit(False)).alias("hit"), F.col("text").cast("string").alias("text"))
    out = out.withColumn("found", F.when(F.col("hit"), F.regexp_extract_all("text", F.lit(_ANY), F.lit(0))))
    out = out.withColumn("found", F.expr(f"transform(found, m -> {_pseudonym('m', key)})"))
    out = out.withColumn("rest", F.when(F.col("hit"), F.split("text", _ANY, -1)))
    # the text between the matches, each followed by what stands for the match
    glued = "array_join(transform(rest, (r, i) -> concat(r, coalesce(get(found, i).value, ''))), '')"
    out = out.withColumn("text", F.when(F.col("hit"), F.expr(glued)).otherwise(F.col("text")))
    out = out.withColumn("n_pii", F.when(F.col("hit"), F.expr("aggregate(found, 0, (s, f) -> s + f.n)")).otherwise(0).cast("long"))
    new = F.col("own").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        new = new.withField("n_chars", F.when(F.col("n_pii") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("own.n_chars")))
    # one struct, inlined: a caller's filter on n_pii or text does not copy the replacing below itself
    row = out.select(*(new.getField(c).alias(c) for c in docs.columns if c != "n_pii"), "n_pii")
    return row.select(F.inline(F.array(F.struct(*(F.col(f"`{c}`") for c in row.columns)))))
