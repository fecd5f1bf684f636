"""Operator 9: format-preserving pseudonyms for personal data, as DataFrame expressions only.

Validated values (payment card numbers by check digit, IPv4 addresses by octet range, social security
numbers by their area, group and serial rules, calendar dates, telephone numbers and e-mail addresses by
form) are replaced by a keyed permutation of their own kind: an alternating Feistel network over two
moduli a and b with a * b values, L += F(R) mod a, R += F(L) mod b, whose round function is a keyed SHA-256.
It is a bijection on each format, so equal values stay equal in every document, different ones stay
different, and a pseudonym passes the same validation as the value: cards keep length, grouping, leading
digit and a right check digit; dates stay dates within their 73,000-day era; addresses stay addresses;
e-mail addresses keep their domain and the letter and digit positions of the local part.

The text is split at the matches of one pattern and put together again with the replaced matches, so
text between values is untouched, and values that fail validation stay as they are. A text without a
digit or "@" is passed through after one look.

Defined results: null texts stay null with 0 values found, empty texts stay empty; repeated rows get equal
results; an empty table gives an empty result; all other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh

ROUNDS, ERA_DAYS, ERA_START = 8, 73_000, "1000-01-01"

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])"
_EDGE, _END = r"(?<![0-9A-Za-z.+-])", r"(?![0-9A-Za-z])"
_IP = rf"{_EDGE}(?:[0-9]{{1,3}}\.){{3}}[0-9]{{1,3}}(?![0-9A-Za-z]|\.[0-9])"
_DATE = rf"{_EDGE}(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}([/.])[0-9]{{2}}\1[0-9]{{4}}){_END}"
_SSN = rf"{_EDGE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_END}"
_CARD = rf"(?<![0-9A-Za-z])(?:[0-9]{{4}}([ -])[0-9]{{4}}\2[0-9]{{4}}\2[0-9]{{1,7}}|[0-9]{{4}}([ -])[0-9]{{6}}\3[0-9]{{5}}|[0-9]{{13,19}}){_END}"
_PHONE = (r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
          r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])")
PATTERN = "|".join((_EMAIL, _DATE, _SSN, _IP, _PHONE, _CARD))


def feistel(value: str, a: str, b: str, tag: str, key: str) -> str:
    """SQL for the permutation of ``value`` in [0, a * b)."""
    f = f"cast(conv(substr(sha2(concat_ws('|', {key}, {tag}, cast(i as string), cast({{half}} as string)), 256), 1, 14), 16, 10) as bigint)"
    return (f"aggregate(sequence(1, {ROUNDS}), struct(({value}) div ({b}) as l, ({value}) % ({b}) as r), (s, i) -> if(i % 2 = 1, "
            f"struct((s.l + {f.format(half='s.r')}) % ({a}) as l, s.r as r), struct(s.l as l, (s.r + {f.format(half='s.l')}) % ({b}) as r)), "
            f"s -> s.l * ({b}) + s.r)")


def _digits(d: str, tag: str, key: str) -> str:
    """SQL: the digit string ``d`` (at most 18) permuted among the strings of its length."""
    n = f"length({d})"
    power = lambda e: f"cast(pow(10, {e}) as bigint)"
    return (f"lpad(cast({feistel(f'cast({d} as bigint)', power(f'{n} div 2'), power(f'({n} - {n} div 2)'), f'concat({tag}, {n})', key)} as string), "
            f"{n}, '0')")


def _refill(x: str, d: str) -> str:
    """SQL: ``x`` with its digits replaced one by one by those of ``d``."""
    return (f"aggregate(sequence(1, length({x})), struct('' as o, 1 as k), (s, i) -> if(substr({x}, i, 1) rlike '[0-9]', "
            f"struct(concat(s.o, substr({d}, s.k, 1)) as o, s.k + 1 as k), struct(concat(s.o, substr({x}, i, 1)) as o, s.k as k)), s -> s.o)")


def _luhn(d: str, odd: int) -> str:
    """SQL: check sum of the digit string; ``odd``: which digits from the right are doubled."""
    c = f"cast(substr({d}, length({d}) - i + 1, 1) as int)"
    return f"aggregate(sequence(1, length({d})), 0, (s, i) -> s + if(i % 2 = {odd}, {c} * 2 - if({c} > 4, 9, 0), {c}))"


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _kind(x: str) -> str:
    """SQL: the validated kind of a match, or null."""
    d = f"regexp_replace({x}, '[^0-9]', '')"
    octets = f"forall(split({x}, '[.]'), o -> cast(o as int) <= 255 and (o = '0' or not startswith(o, '0')))"
    return (f"case when contains({x}, '@') then 'email' when {x} rlike '^([0-9]{{1,3}}[.]){{3}}[0-9]{{1,3}}$' then if({octets}, 'ip', null) "
            f"when {x} rlike '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}[./][0-9]{{2}}[./][0-9]{{4}})$' then if({_day(x)} is not null, 'date', null) "
            f"when {x} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then if({x} rlike '^(?!000|666|9)[0-9]{{3}}-(?!00)[0-9]{{2}}-(?!0000)[0-9]{{4}}$', 'ssn', null) "
            f"when {x} rlike '^[0-9 -]+$' and length({d}) between 13 and 19 then if({_luhn(d, 0)} % 10 = 0, 'card', null) else 'phone' end")


def _day(x: str) -> str:
    """SQL: the date of a match (year first; month first; else day first), null if it is none."""
    parts = [f"substr({x}, {a}, {n})" for a, n in ((7, 4), (1, 2), (4, 2))]
    day = f"try_cast(concat_ws('-', {', '.join(parts)}) as date)"
    swap = f"try_cast(concat_ws('-', {parts[0]}, {parts[2]}, {parts[1]}) as date)"
    whole = f"if(substr({x}, 5, 1) = '-', try_cast({x} as date), coalesce({day}, {swap}))"
    return f"if({whole} >= date'{ERA_START}', {whole}, null)"


def _date_out(x: str, key: str) -> str:
    at = f"cast(datediff({_day(x)}, date'{ERA_START}') as bigint)"
    moved = f"date_add(date'{ERA_START}', cast(({at} div {ERA_DAYS}) * {ERA_DAYS} + {feistel(f'{at} % {ERA_DAYS}', '250', '292', f'concat({chr(39)}date{chr(39)}, {at} div {ERA_DAYS})', key)} as int))"
    by_month = f"try_cast(concat_ws('-', substr({x}, 7, 4), substr({x}, 1, 2), substr({x}, 4, 2)) as date) is not null"
    mark = f"substr({x}, 3, 1)"
    return _let("m", moved, f"if(substr({x}, 5, 1) = '-', date_format(m, 'yyyy-MM-dd'), concat(if({by_month}, date_format(m, 'MM'), date_format(m, 'dd')), "
                            f"{mark}, if({by_month}, date_format(m, 'dd'), date_format(m, 'MM')), {mark}, date_format(m, 'yyyy')))")


def _email_out(x: str, key: str) -> str:
    """Letters and digits of the local part, eight at a time; each eight under the domain and what came before."""
    local, domain = f"substring_index({x}, '@', 1)", f"substring_index({x}, '@', -1)"
    alphabet = "case when c rlike '[0-9]' then '0123456789' when c rlike '[a-z]' then 'abcdefghijklmnopqrstuvwxyz' else 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' end"
    radix = lambda cs: f"aggregate({cs}, bigint(1), (p, c) -> p * if(c rlike '[0-9]', 10, 26))"
    value = f"aggregate(e, bigint(0), (v, c) -> v * if(c rlike '[0-9]', 10, 26) + instr({alphabet}, c) - 1)"
    a, b = radix("slice(e, 1, size(e) div 2)"), radix("slice(e, size(e) div 2 + 1, size(e))")
    moved = feistel("v", "ma", "mb", f"concat('email', {domain}, '/', concat_ws('', slice(cs, 1, j * 8)), '/', concat_ws('', transform(e, c -> if(c rlike '[0-9]', 'd', if(c rlike '[a-z]', 'l', 'u')))))", key)
    back = ("aggregate(reverse(e), struct(w as v, '' as o), (s, c) -> if(c rlike '[0-9]', struct(s.v div 10 as v, concat(cast(s.v % 10 as string), s.o) as o), "
            "struct(s.v div 26 as v, concat(char(s.v % 26 + if(c rlike '[a-z]', 97, 65)), s.o) as o)), s -> s.o)")
    chunk = _let("v", value, _let("ma", a, _let("mb", b, _let("w", moved, back))))
    changed = f"array_join(transform(sequence(0, (size(cs) - 1) div 8), j -> {_let('e', 'slice(cs, j * 8 + 1, 8)', chunk)}), '')"
    refill = (f"aggregate(sequence(1, length({local})), struct('' as o, 1 as k), (s, i) -> if(substr({local}, i, 1) rlike '[A-Za-z0-9]', "
              f"struct(concat(s.o, substr(n, s.k, 1)) as o, s.k + 1 as k), struct(concat(s.o, substr({local}, i, 1)) as o, s.k as k)), s -> concat(s.o, '@', {domain}))")
    return _let("cs", f"regexp_extract_all({local}, '[A-Za-z0-9]', 0)", f"if(size(cs) = 0, {x}, {_let('n', changed, refill)})")


def pseudonym(x: str, key: str) -> str:
    """SQL: the pseudonym of a match, or the match itself where it is not valid."""
    d = f"regexp_replace({x}, '[^0-9]', '')"
    ip = f"aggregate(split({x}, '[.]'), bigint(0), (v, o) -> v * 256 + cast(o as bigint))"
    ip_out = _let("v", feistel(ip, "65536", "65536", "'ip'", key), "concat_ws('.', v div 16777216, v div 65536 % 256, v div 256 % 256, v % 256)")
    area = f"cast(substr({d}, 1, 3) as bigint)"
    ssn = f"(({area} - 1 - if({area} > 666, 1, 0)) * 99 + cast(substr({d}, 4, 2) as bigint) - 1) * 9999 + cast(substr({d}, 6, 4) as bigint) - 1"
    ssn_out = _let("v", feistel(ssn, "88902", "9999", "'ssn'", key), _let(
        "g", "v div 9999 div 99 + 1", "concat_ws('-', lpad(cast(g + if(g >= 666, 1, 0) as string), 3, '0'), "
        "lpad(cast(v div 9999 % 99 + 1 as string), 2, '0'), lpad(cast(v % 9999 + 1 as string), 4, '0'))"))
    body = f"concat(substr({d}, 1, 1), {_digits(f'substr({d}, 2, length({d}) - 2)', f'concat({chr(39)}card{chr(39)}, substr({d}, 1, 1))', key)})"
    card_out = _let("c", body, _refill(x, f"concat(c, cast((10 - {_luhn('c', 1)} % 10) % 10 as string))"))
    kept = f"greatest(if(startswith({x}, '+') or length({d}) = 11, 1, 0), length({d}) - 10)"
    phone_out = _let("p", f"concat(substr({d}, 1, {kept}), {_digits(f'substr({d}, {kept} + 1)', f'concat({chr(39)}phone{chr(39)}, substr({d}, 1, {kept}))', key)})", _refill(x, "p"))
    return (f"case {_kind(x)} when 'email' then {_email_out(x, key)} when 'ip' then {ip_out} when 'date' then {_date_out(x, key)} "
            f"when 'ssn' then {ssn_out} when 'card' then {card_out} when 'phone' then {phone_out} else {x} end")


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``; ``found_col``: also the number of values replaced."""
    held, parts, new, count = fresh(docs, "matches", "parts", "pseudonyms", "replaced")
    secret = "'" + key.replace("\\", "\\\\").replace("'", "\\'") + "'"
    text = docs[text_col]
    some = F.coalesce(text.rlike("[0-9@]"), F.lit(False))
    frame = docs.withColumn(held, F.when(some, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))) \
        .withColumn(new, F.when(F.size(held) > 0, F.expr(f"transform(`{held}`, x -> {pseudonym('x', secret)})")))
    joined = F.expr(f"array_join(transform(split(`{text_col}`, r'{PATTERN}', -1), (s, i) -> concat(s, coalesce(get(`{new}`, i), ''))), '')")
    frame = frame.withColumn(parts, F.when(F.col(new).isNotNull(), joined).otherwise(F.col(text_col)))
    number = F.coalesce(F.expr(f"size(filter(arrays_zip(`{held}`, `{new}`), z -> z.`{held}` <> z.`{new}`))"), F.lit(0))
    out = [F.col(parts).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return frame.withColumn(count, F.when(F.col(new).isNotNull(), number).otherwise(0)).select(
        *out, *([F.col(count).cast("long").alias(found_col)] if found_col else []))
