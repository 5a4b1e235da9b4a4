"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts the score.

Built from SQL functions only.  A pattern is applied twice: ``regexp_extract_all``
gives the matches and ``split`` the text between them, so that the running sum of
their lengths gives each match's place in code points.  Sums and redacted texts are built in
blocks of ``BLOCK`` and context comes from the pieces before a match, so that the time
follows the length of a text, also of one with very many matches.

Base kinds (always kept when their own check passes): ``email``; ``ip`` with
parts up to 255; ``card`` of 13 to 19 digits passing Luhn; ``phone`` of 9 to 15
digits.  Added kinds: ``iban`` confirmed by mod 97; ``ssn``, which has no
checksum and is kept only near a context word; ``secret``, 16 or more letters, digits, ``_`` and ``-``
with a letter and three digits, kept only right after a word such as ``token`` or ``password`` and a sign.

Defined cases: a null or empty text has no spans; every row gives one row
(repeated rows and null ids included); other columns are kept by ``find_pii``,
whose result columns are named by its caller.  Spans of different kinds may
overlap; ``redacted`` writes one tag per overlapping run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts, unused

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "ssn", "secret")
#: Matches whose places, or spans whose tags, are put in at a time.
BLOCK = 256

# The patterns.  Possessive forms and the "end of the last match or no
# such character before" guard keep the search linear without changing the matches.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+",
}
# A text without this cannot match; cheap to test.
NEEDS = {
    "email": "instr(t, '@') > 0",
    "ip": r"t rlike '[0-9]\\.[0-9]'",
    "card": r"t rlike '[0-9](?:[\\x20-]?[0-9]){12}'",
    "phone": "instr(t, '+') > 0",
    "iban": "t rlike '[A-Z]{2}[0-9]{2}'",
    "ssn": "t rlike '[0-9]{3}-[0-9]{2}-[0-9]{4}'",
    "secret": "t rlike '(?i)(?:token|secret|passw(?:or)?d|pwd|key)[^A-Za-z0-9_-]{1,5}[A-Za-z0-9_-]{16}'",
}
CONTEXT = {
    "email": "mail|contact|write to|correo|courriel",
    "ip": "address|server|host|login",
    "card": "card|visa|credit|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social security|social insurance|tax id",
    "secret": r"(?:token|secret|passw(?:or)?d|pwd|key)[^a-z0-9_-]{1,5}\z",
}
CONTEXT_CHARS = 40
#: A match and the text before it have 3 characters or more (adjacent e-mail addresses have none between, but 5 or
#: more of their own), so that so many pieces before a match hold its context.
CONTEXT_PIECES = 14
# Score: the proposal, plus what its checksum and a context word add.
PROPOSED = {"email": 0.7, "ip": 0.7, "card": 0.4, "phone": 0.7, "iban": 0.4, "ssn": 0.4, "secret": 0.2}
CHECKED = {"email": 0.0, "ip": 0.1, "card": 0.4, "phone": 0.1, "iban": 0.4, "ssn": 0.0, "secret": 0.2}
NEAR_WORD = 0.2
LEAST_SCORE = 0.6

_DIGITS = "regexp_replace({m}, '[^0-9]', '')"
_MOD97 = ("aggregate(split(concat(substring({c}, 5), substring({c}, 1, 4)), ''), 0, (r, h) -> case"
          " when h = '' then r"
          " when h between '0' and '9' then (r * 10 + ascii(h) - 48) % 97"
          " else (r * 100 + ascii(h) - 55) % 97 end) = 1")


def _check(kind: str, m: str) -> str:
    """SQL of the check that a match ``m`` has to pass."""
    digits = _DIGITS.format(m=m)
    return {
        "email": "true",
        "ssn": "true",
        "ip": (f"forall(split({m}, '[.]'), p -> length(trim(leading '0' from p)) <= 3"
               " and cast(concat('0', substring(trim(leading '0' from p), 1, 3)) as int) <= 255)"),
        "card": f"length({digits}) between 13 and 19 and luhn_check({digits})",
        "phone": f"length({digits}) between 9 and 15",
        "iban": _MOD97.format(c=f"replace({m}, ' ', '')"),
        "secret": f"{m} rlike '[A-Za-z]' and length({digits}) >= 3",
    }[kind]


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def _blocks(array: str) -> str:
    """SQL: the array (not empty) as blocks of ``BLOCK`` elements."""
    return f"transform(sequence(0, (size({array}) - 1) div {BLOCK}), k -> slice({array}, k * {BLOCK} + 1, {BLOCK}))"


def _running(array: str, step: str) -> str:
    """SQL: a fold's values before the first and after each element; ``step`` joins ``v`` and the element ``x``."""
    return (f"aggregate({array}, array(0), (a, x) -> concat(a, transform(slice(a, -1, 1), v -> {step})))")


def _sums(kind: str) -> str:
    """SQL: the lengths of each match and the text before it, in blocks."""
    lengths = f"zip_with(slice(b_{kind}, 1, size(m_{kind})), m_{kind}, (b, m) -> length(b) + length(m))"
    return f"transform(array({lengths}), s -> {_blocks('s')})[0]"


def _ends(kind: str) -> str:
    """SQL: where each match ends, from the blocks of lengths."""
    before = _running(f"transform(l_{kind}, l -> aggregate(l, 0, (a, x) -> a + x))", "v + x")
    return (f"flatten(zip_with(l_{kind}, slice({before}, 1, size(l_{kind})), (l, p) ->"
            f" transform(slice({_running('l', 'v + x')}, 2, {BLOCK}), e -> e + p)))")


def _pieces(kind: str) -> str:
    """SQL: the last characters of the text up to the end of each match, from the end of the match before."""
    return (f"zip_with(slice(b_{kind}, 1, size(m_{kind})), m_{kind},"
            f" (b, m) -> right(concat(right(b, {CONTEXT_CHARS}), m), {CONTEXT_CHARS}))")


def _spans(kind: str) -> str:
    """SQL: the kind's spans, from its matches, their ends, the text between them and the pieces before."""
    before = (f"concat(array_join(slice(c_{kind}, greatest(i - {CONTEXT_PIECES - 1}, 1),"
              f" least(i, {CONTEXT_PIECES})), ''), right(b_{kind}[i], {CONTEXT_CHARS}))")
    near = f"lower(right({before}, {CONTEXT_CHARS})) rlike {_quoted(CONTEXT[kind])}"
    score = f"{PROPOSED[kind] + CHECKED[kind]}D + if({near}, {NEAR_WORD}D, 0D)"
    found = (f"transform(m_{kind}, (m, i) -> if({_check(kind, 'm')}, named_struct('kind', '{kind}',"
             f" 'start', e_{kind}[i] - length(m), 'end', e_{kind}[i], 'score', round({score}, 2)), null))")
    return f"filter({found}, s -> s.score >= {LEAST_SCORE}D)"


def _if_any(kind: str, what: str, of: str) -> Column:
    return F.expr(f"if(size(m_{kind}) > 0, {what}, cast(array() as array<{of}>))")


def find_pii(df: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``df`` and its rows' spans: array<struct<kind, start, end, score>> by kind, then start.

    Places are code points, the end exclusive.  The columns of ``df`` stay (``out`` must be a new name).
    """
    keep = [df[c] for c in df.columns]
    hold = unused(df, "row")
    f = df.select(F.struct(*keep).alias(hold), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("t"))
    found = f.select(
        hold, "t",
        *[F.expr(f"if({NEEDS[k]}, regexp_extract_all(t, {_quoted(PATTERNS[k])}, 0),"
                 " cast(array() as array<string>))").alias(f"m_{k}") for k in KINDS])
    parts = found.select(
        hold, "t", *[f"m_{k}" for k in KINDS],
        *[F.expr(f"if(size(m_{k}) > 0, split(t, {_quoted(PATTERNS[k])}, -1), cast(array() as array<string>))")
          .alias(f"b_{k}") for k in KINDS])
    for name, what, of in (("l", _sums, "array<int>"), ("e", _ends, "int"), ("c", _pieces, "string")):
        parts = parts.select("*", *[_if_any(k, what(k), of).alias(f"{name}_{k}") for k in KINDS])
    none = "struct<kind:string,start:int,end:int,score:double>"
    spans = F.concat(*[_if_any(k, _spans(k), none) for k in KINDS])
    return parts.select(hold, spans.alias("spans")).select(f"{hold}.*", F.col("spans").alias(out))


def digest(spans: Column, kinds=KINDS) -> Column:
    """``kind:start:end`` of the spans of the given kinds, comma-joined in order."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with personal data in ``text_col`` replaced by its kind in angle brackets, as ``<email>``.

    Rows without any are unchanged (nulls too).  A span that begins inside one before it gets no tag of its own.
    """
    name = unused(df, "pii")
    f = find_pii(df, text_col, name)
    f = f.select(F.struct(*[f[c] for c in df.columns]).alias("h"), f[text_col].cast("string").alias("t"),
                 F.sort_array(F.transform(name, lambda s: F.struct(
                     s["start"].alias("s"), (-s["end"]).alias("e"), s["kind"].alias("k")))).alias("o"))
    f = f.select("h", "t", F.expr(f"if(size(o) > 0, {_blocks('o')}, null)").alias("o"))
    # the farthest end before each block: a block's part of the text lies between its own and the next one's
    f = f.select("h", "t", "o", F.expr(_running("transform(o, b -> -array_min(transform(b, x -> x.e)))",
                                                "greatest(v, x)")).alias("p"))
    tag = ("named_struct('p', greatest(a.p, -x.e), 'out', if(x.s >= a.p, concat(a.out,"
           " substring(g, a.p - q + 1, x.s - a.p), '<', x.k, '>'), a.out))")
    block = ("transform(array(substring(t, p[i] + 1, p[i + 1] - p[i])), g -> transform(array(p[i]), q ->"
             f" aggregate(b, named_struct('p', q, 'out', ''), (a, x) -> {tag}, a -> a.out))[0])[0]")
    clean = F.expr(f"concat(array_join(transform(o, (b, i) -> {block}), ''),"
                   " substring(t, element_at(p, -1) + 1))")
    f = f.select("h", F.when(F.col("o").isNotNull(), clean).otherwise(F.col("t")).alias("clean"))
    return f.select(*[F.col("clean").cast(df.schema[c].dataType).alias(c) if c == text_col else F.col(f"h.{c}").alias(c)
                      for c in df.columns])


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, a hash of the base spans, and all spans as text."""
    f = find_pii(texts(docs, id_col, text_col), "text", "pii")
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return f.select("doc_id", *[count(k) for k in BASE_KINDS],
                    F.sha2(digest(F.col("pii"), BASE_KINDS), 256).alias("base_sha256"),
                    digest(F.col("pii")).alias("spans"))
