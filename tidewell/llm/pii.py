"""Format-preserving pseudonyms for personal data, with Spark SQL expressions only.

Numbers and dates that pass their check, and e-mail addresses, are replaced by a keyed
Feistel permutation within their own format: a card number becomes another card number
that passes the check digit, a date another date, an address one of the same shape.  The
permutation depends on the key and the value alone, so equal values stay equal (and
different ones different) in all documents, without a table of values and without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8
# the last label of an address; those before it are read up to the last one that it follows, so a
# full stop after an address is no part of it
_TOP = r"[A-Za-z]{2,24}(?![A-Za-z0-9])"
# numbers of other kinds that may follow a phone number and a space
_NEXT = (r"(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4}|\d{3}-\d{2}-\d{4}|\d{1,3}(?:\.\d{1,3}){3}|\d{13,19}"
         r"|\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4}(?: \d{6} |-\d{6}-)\d{5}|\d{3}[.\-]\d{3}[.\-]\d{4})(?!\d)")
# What is looked for.  No pattern can run back over more than it has just read.
PATTERNS = {
    "email": (r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@"
              rf"(?:(?:[A-Za-z0-9\-]++\.(?!{_TOP}))*+[A-Za-z0-9\-]++\.(?={_TOP}))++{_TOP}"),
    "secret": r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])",
    # the usual ten national digits; else 8 to 15 after '+', grouped anyhow, up to a value of another kind
    "phone": (r"(?<![\w+.\-])\+\d{1,3}[ .\-]?\(?\d{3}\)?[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)"
              rf"|(?<![\w+.\-])\+\d(?:(?: (?!{_NEXT})|[.\-])?\(?\d\)?){{7,14}}(?!\d)"
              r"|(?<![\w.\-])(?:\(\d{3}\) ?|\d{3}[\-.])\d{3}[\-.]\d{4}(?!\d)|(?<![\w.\-])\d{3} \d{3} \d{4}(?!\d)"),
    "card": (r"(?<![\w.\-])\d{13,19}(?![\w])|(?<![\w.\-])\d{4}([ \-])\d{4}\1\d{4}\1\d{4}(?![\w])"
             r"|(?<![\w.\-])\d{4}(?: \d{6} |-\d{6}-)\d{5}(?![\w])"),
    "ssn": r"(?<![\w.\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "date": r"(?<![\w.\-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w\-])",
    "ip": r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)",
}
# dates are permuted among the days of a 400-year cycle, 146,097 = 189 * 773
FIRST_DAY, DAYS_HIGH, DAYS_LOW = "1800-01-01", 189, 773
_DATE_FORMATS = (("-", "yyyy-MM-dd"), (".", "dd.MM.yyyy"), ("/", "MM/dd/yyyy"))


def _combined() -> str:
    """One pattern of all kinds; its only group is the separator of card numbers."""
    order = ("email", "secret", "date", "phone", "ssn", "ip", "card")
    return "|".join(f"(?:{PATTERNS[k]})" for k in order)


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digest(key: str, kind: str, r: str, size: str, half: str) -> str:
    """Round function: SHA-256 of key, kind, round, size of the value and the other half."""
    return f"sha2(concat_ws('|', {_quote(key)}, '{kind}', cast({r} AS string), cast({size} AS string), {half}), 256)"


def _number(digest: str) -> str:
    return f"cast(conv(substring({digest}, 1, 12), 16, 10) AS bigint)"


def _shifted(half: str, digest: str, hexadecimal: bool) -> str:
    """Every digit and letter of a half moved within its class by a byte of the digest."""
    move = "cast(conv(substring(k, 2 * ((i - 1) % 32) + 1, 2), 16, 10) AS int)"
    c = f"substring({half}, i, 1)"
    if hexadecimal:
        step = f"substring('0123456789abcdef', (instr('0123456789abcdef', {c}) - 1 + {move}) % 16 + 1, 1)"
    else:
        step = (f"CASE WHEN {c} BETWEEN '0' AND '9' THEN chr(48 + (ascii({c}) - 48 + {move}) % 10) "
                f"WHEN {c} BETWEEN 'a' AND 'z' THEN chr(97 + (ascii({c}) - 97 + {move}) % 26) "
                f"WHEN {c} BETWEEN 'A' AND 'Z' THEN chr(65 + (ascii({c}) - 65 + {move}) % 26) ELSE {c} END")
    return (f"CASE WHEN length({half}) = 0 THEN '' ELSE element_at(transform(array({digest}), k -> "
            f"array_join(transform(sequence(1, length({half})), i -> {step}), '')), 1) END")


def feistel_text(value: str, key: str, kind: str, hexadecimal: bool = False) -> str:
    """SQL: the permuted string, class by class of the same shape (``value`` is a SQL expression)."""
    low = _shifted("h.a", _digest(key, kind, "r", "h.n", "h.b"), hexadecimal)
    high = _shifted("h.b", _digest(key, kind, "r", "h.n", "h.a"), hexadecimal)
    return f"""element_at(transform(array({value}), x -> aggregate(sequence(1, {ROUNDS}),
      named_struct('a', substring(x, 1, length(x) div 2), 'b', substring(x, length(x) div 2 + 1, length(x)), 'n', length(x)),
      (h, r) -> CASE WHEN r % 2 = 1 THEN named_struct('a', {low}, 'b', h.b, 'n', h.n)
                     ELSE named_struct('a', h.a, 'b', {high}, 'n', h.n) END,
      h -> concat(h.a, h.b))), 1)"""


def feistel_pair(high: str, low: str, n_high: int, n_low: int, key: str, kind: str) -> str:
    """SQL: struct (a, b), the permutation of (high, low) in [0, n_high) x [0, n_low)."""
    a = f"(h.a + {_number(_digest(key, kind, 'r', '0', 'cast(h.b AS string)'))}) % {n_high}"
    b = f"(h.b + {_number(_digest(key, kind, 'r', '0', 'cast(h.a AS string)'))}) % {n_low}"
    return f"""aggregate(sequence(1, {ROUNDS}), named_struct('a', cast({high} AS bigint), 'b', cast({low} AS bigint)),
      (h, r) -> CASE WHEN r % 2 = 1 THEN named_struct('a', {a}, 'b', h.b) ELSE named_struct('a', h.a, 'b', {b}) END)"""


def _bind(value: str, name: str, body: str) -> str:
    """SQL ``let``: body with name standing for the value, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _luhn_sum(digits: str, doubled: int) -> str:
    """Sum of the check rule; counted from the right, every position of parity ``doubled`` is doubled."""
    d = f"cast(substring({digits}, length({digits}) - i + 1, 1) AS int)"
    return (f"aggregate(transform(sequence(1, length({digits})), i -> CASE WHEN i % 2 = {doubled} "
            f"THEN (2 * {d}) div 10 + (2 * {d}) % 10 ELSE {d} END), 0L, (t, x) -> t + x)")


def _refill(m: str, digits: str) -> str:
    """The digits of a match replaced in order; everything else stays."""
    return (f"aggregate(split({m}, ''), named_struct('s', '', 'i', 1), (f, c) -> CASE WHEN c BETWEEN '0' AND '9' "
            f"THEN named_struct('s', concat(f.s, substring({digits}, f.i, 1)), 'i', f.i + 1) "
            f"ELSE named_struct('s', concat(f.s, c), 'i', f.i) END, f -> f.s)")


def _pseudonym(key: str) -> str:
    """SQL over a match ``m``: struct of its kind (null: left alone) and its replacement."""
    digits = "regexp_replace(m, '[^0-9]', '')"

    def kind_is(kind: str) -> str:
        return f"m RLIKE {_quote('^(?:' + PATTERNS[kind] + ')$')}"

    def out(kind: str, value: str) -> str:
        return f"named_struct('kind', '{kind}', 'text', {value})"

    email = _bind("substring(m, 1, length(m) - length(substring_index(m, '.', -1)) - 1)", "s",
                  f"concat({feistel_text('s', key, 'email')}, '.', substring_index(m, '.', -1))")
    secret = feistel_text("m", key, "secret", hexadecimal=True)
    # after '+', one to three digits stay as the country's, all but ten where that fits
    country = "CASE WHEN m LIKE '+%' THEN greatest(1, least(3, length(d) - 10)) ELSE 0 END"
    phone = _bind(digits, "d", _refill("m", f"concat(substring(d, 1, {country}), "
                                       + feistel_text(f"substring(d, {country} + 1, length(d))", key, "phone") + ")"))
    card = _bind(feistel_text(f"substring({digits}, 1, length({digits}) - 1)", key, "card"), "d",
                 _refill("m", f"concat(d, cast((10 - {_luhn_sum('d', 1)} % 10) % 10 AS string))"))
    # area 001-899 without 666, group 01-99, serial 0001-9999
    area, group, serial = (f"cast(split(m, '-')[{i}] AS int)" for i in range(3))
    ssn = _bind(feistel_pair(f"({area} - 1 - CASE WHEN {area} > 666 THEN 1 ELSE 0 END) * 99 + {group} - 1",
                             f"{serial} - 1", 898 * 99, 9999, key, "ssn"), "p",
                "concat_ws('-', lpad(cast(p.a div 99 + 1 + CASE WHEN p.a div 99 + 1 >= 666 THEN 1 ELSE 0 END AS string), 3, '0'),"
                " lpad(cast(p.a % 99 + 1 AS string), 2, '0'), lpad(cast(p.b + 1 AS string), 4, '0'))")
    octet = [f"cast(split(m, '[.]')[{i}] AS int)" for i in range(4)]
    ip = _bind(feistel_pair(f"{octet[0]} * 256 + {octet[1]}", f"{octet[2]} * 256 + {octet[3]}", 65536, 65536, key, "ip"), "p",
               "concat_ws('.', cast(p.a div 256 AS string), cast(p.a % 256 AS string), "
               "cast(p.b div 256 AS string), cast(p.b % 256 AS string))")
    parsed = "CASE " + " ".join(f"WHEN instr(m, '{sep}') > 0 THEN cast(try_to_timestamp(m, '{f}') AS date)"
                                for sep, f in _DATE_FORMATS) + " END"
    written = "CASE " + " ".join(f"WHEN instr(m, '{sep}') > 0 THEN date_format(q, '{f}')" for sep, f in _DATE_FORMATS) + " END"
    day = f"datediff({parsed}, DATE'{FIRST_DAY}')"
    cycle = DAYS_HIGH * DAYS_LOW
    date = _bind(feistel_pair(f"{day} div {DAYS_LOW}", f"{day} % {DAYS_LOW}", DAYS_HIGH, DAYS_LOW, key, "date"), "p",
                 _bind(f"date_add(DATE'{FIRST_DAY}', cast(p.a * {DAYS_LOW} + p.b AS int))", "q", written))
    return f"""CASE
      WHEN m LIKE '%@%' THEN {out('email', email)}
      WHEN {kind_is('secret')} AND m RLIKE '[a-f]' THEN {out('secret', secret)}
      WHEN {kind_is('date')} THEN CASE WHEN coalesce({day} BETWEEN 0 AND {cycle - 1}, false) THEN {out('date', date)}
                                  ELSE named_struct('kind', cast(NULL AS string), 'text', m) END
      WHEN {kind_is('ssn')} THEN CASE WHEN {area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0
                                 THEN {out('ssn', ssn)} ELSE named_struct('kind', cast(NULL AS string), 'text', m) END
      WHEN {kind_is('ip')} THEN CASE WHEN forall(split(m, '[.]'), o -> cast(o AS int) <= 255) THEN {out('ip', ip)}
                                ELSE named_struct('kind', cast(NULL AS string), 'text', m) END
      WHEN m LIKE '+%' OR {kind_is('phone')} THEN {out('phone', phone)}
      WHEN {_luhn_sum(digits, 0)} % 10 = 0 AND length({digits}) BETWEEN 13 AND 19 THEN {out('card', card)}
      ELSE named_struct('kind', cast(NULL AS string), 'text', m) END"""


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", out_col: str = "text",
                 kinds_col: str | None = "pii_kinds") -> DataFrame:
    """``docs`` with pseudonyms in ``out_col`` and, in ``kinds_col``, the kind of each replaced value.

    Replaced: e-mail addresses; hexadecimal secrets of 32 to 64 digits; phone numbers of ten
    national digits, or of 8 to 15 digits after a plus sign in any grouping; card numbers with a valid check digit; valid social security numbers;
    valid IPv4 addresses; valid dates of the years 1800 to 2199.  Numbers that fail their
    check stay.  Null stays null (with no kinds); empty texts stay empty; every row is treated
    alone, so ids, ties and repeated rows do not matter; existing columns of the output names
    are replaced; an empty table gives an empty table.
    """
    pattern = _quote(_combined())
    # the row stays apart from the working columns, so no name can clash
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    d = d.withColumn("found", F.when(F.col("text").rlike(_combined()), F.expr(f"regexp_extract_all(text, {pattern}, 0)")))
    d = d.withColumn("new", F.expr(f"transform(found, m -> {_pseudonym(key)})"))
    pieces = F.expr(f"split(text, {pattern}, -1)")
    joined = F.array_join(F.zip_with(pieces, F.concat(F.transform("new", lambda p: p["text"]), F.array(F.lit(""))),
                                     lambda a, b: F.concat(a, b)), "")
    kinds = F.coalesce(F.filter(F.transform("new", lambda p: p["kind"]), lambda k: k.isNotNull()),
                       F.array().cast("array<string>"))
    made = {out_col: F.when(F.col("new").isNull(), F.col("text")).otherwise(joined)}
    if kinds_col:
        made[kinds_col] = kinds
    kept = [made.pop(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    return d.select(*kept, *[v.alias(c) for c, v in made.items()])


def count_kind(kinds: Column, kind: str) -> Column:
    return F.size(F.filter(kinds, lambda k: k == kind)).cast("long")


KINDS = tuple(PATTERNS)


def counts(kinds: Column) -> list[Column]:
    """One count column per kind."""
    return [count_kind(kinds, k).alias(f"n_{k}") for k in KINDS]

