"""Fill-in-middle transformation by a counted-quantifier regular expression.

A unit is a run of A-Z/a-z or any other single code point. ``regexp_count``
gives a text's units n; three hash numbers of the row place two cuts a <= b
between units and choose the form. One match of the row's own pattern

    \\A((?:unit){a}+)((?:unit){b-a}+)((?s:.*+))

captures prefix, middle and suffix, and the replacement writes them in the
order of the form, with the marks between. The groups are possessive: the
engine walks a possessive counted group in a loop, while a backtracking one
calls itself once a unit and overflows the stack on long texts.

``<P>prefix<S>suffix<M>middle`` is the form psm, ``<S>suffix<P>prefix<M>middle``
is spm. A text that is empty or holds a mark, or whose h3 % 100 reaches
``RATE``, stays plain. As no text that is cut holds a mark, and a mark can't
begin inside a mark, the first place of each mark in an output is the written
one, so output and form alone give the text back (``restored``).

Long texts are counted in pieces of ``PIECE`` code points, less the cuts that
fall inside a run of letters, as ``regexp_count`` builds a list of all matches.

Defined results: null text as empty (plain, n = 0); a null doc_id hashes as
the empty string; repeated rows each get their row, the same for equal
doc_id and text; an empty table gives an empty result; other columns are
dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import texts

#: Fixed values of the format.
UNIT = "[A-Za-z]+|[^A-Za-z]"
P, S, M = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100 texts so many are cut, and of 100 that are cut so many get the form spm.
RATE, SPM_SHARE = 90, 20
#: Code points of a longer text that are counted at once.
PIECE = 1 << 16

_GROUP = "(?:[A-Za-z]++|[^A-Za-z])"


def hash_number(doc_id: Column, k: int) -> Column:
    """h1 to h4: the k-th 8-digit group of the hex SHA-256 of ``1:`` and the doc_id, as an unsigned number."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("bigint")


def units(text: Column) -> Column:
    """How many units a text has."""
    start = lambda i: i.cast("int") * PIECE + 1
    pieces = F.sequence(F.lit(0), F.floor((F.length(text) - 1) / PIECE).cast("int"))

    def count(i: Column) -> Column:
        # A cut inside a run of letters gives one unit too many.
        inside = (i > 0) & F.substring(text, start(i) - 1, F.lit(2)).rlike("^[A-Za-z]{2}$")
        return F.regexp_count(F.substring(text, start(i), F.lit(PIECE)), F.lit(UNIT)).cast("bigint") - inside.cast("bigint")

    longer = F.aggregate(pieces, F.lit(0).cast("bigint"), lambda n, i: n + count(i))
    return F.when(F.length(text) <= PIECE, F.regexp_count(text, F.lit(UNIT)).cast("bigint")).otherwise(longer)


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm_share: int = SPM_SHARE) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per document."""
    rows = texts(docs).withColumn("n", units(F.col("text")))
    h = {k: hash_number(F.col("doc_id"), k) for k in range(1, 5)}
    rows = rows.select("doc_id", "text", "n", *[(h[k] % (F.col("n") + 1)).alias(f"c{k}") for k in (1, 2)], *[(h[k] % 100).alias(f"c{k}") for k in (3, 4)])
    marked = F.col("text").contains(P) | F.col("text").contains(S) | F.col("text").contains(M)
    plain = (F.col("n") == 0) | marked | (F.col("c3") >= rate)
    rows = rows.withColumn("form", F.when(plain, PLAIN).when(F.col("c4") < spm_share, SPM).otherwise(PSM))
    a, b = F.least("c1", "c2"), F.greatest("c1", "c2")
    pattern = F.concat(F.lit(rf"\A((?:{_GROUP})" + "{"), a.cast("string"), F.lit("}+)(" + f"(?:{_GROUP})" + "{"), (b - a).cast("string"), F.lit(r"}+)((?s:.*+))"))
    written = F.when(F.col("form") == SPM, f"{S}$3{P}$1{M}$2").otherwise(f"{P}$1{S}$3{M}$2")
    output = F.when(F.col("form") == PLAIN, F.col("text")).otherwise(F.regexp_replace(F.col("text"), pattern, written))
    rows = rows.select("doc_id", "n", "form", output.alias("output"))
    return rows.select("doc_id", "n", "form", *[part_chars(c).alias(f"{c}_chars") for c in ("prefix", "middle")], "output")


def _ends(output: Column, form: Column) -> dict[str, tuple[Column, Column]]:
    """First place and number of code points of each part in an output that isn't plain."""
    p, s, m = (F.instr(output, x) for x in (P, S, M))
    after = lambda at: at + len(P)
    spm = form == SPM
    return {
        "prefix": (after(p), F.when(spm, m).otherwise(s) - after(p)),
        "suffix": (after(s), F.when(spm, p).otherwise(m) - after(s)),
        "middle": (after(m), F.length(output) + 1 - after(m)),
    }


def part_chars(part: str, output: Column | None = None, form: Column | None = None) -> Column:
    """Code points of a part (``prefix``, ``suffix`` or ``middle``) of an output; null if plain."""
    output, form = F.col("output") if output is None else output, F.col("form") if form is None else form
    return F.when(form != PLAIN, _ends(output, form)[part][1].cast("bigint"))


def restored(output: Column, form: Column) -> Column:
    """The text of an output."""
    ends = _ends(output, form)
    parts = [F.substring(output, *ends[k]) for k in ("prefix", "middle", "suffix")]
    return F.when(form == PLAIN, output).otherwise(F.concat(*parts))


def fim_digests(transformed: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars`` and the digests of the output and of the text rebuilt from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    own = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    return transformed.select(*own, sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '{UNIT}') AS units FROM t),
c AS (SELECT *, len(units) AS n,
             [('0x' || substr(h, 8 * k - 7, 8))::BIGINT FOR k IN [1, 2, 3, 4]] AS x FROM u),
f AS (SELECT *, least(x[1] % (n + 1), x[2] % (n + 1)) AS a, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(text, '{P}') OR contains(text, '{S}') OR contains(text, '{M}') OR x[3] % 100 >= {RATE} THEN '{PLAIN}'
                  WHEN x[4] % 100 < {SPM_SHARE} THEN '{SPM}' ELSE '{PSM}' END AS form FROM c),
p AS (SELECT *, array_to_string(list_slice(units, 1, a), '') AS prefix, array_to_string(list_slice(units, a + 1, b), '') AS middle,
             array_to_string(list_slice(units, b + 1, n), '') AS suffix FROM f),
o AS (SELECT *, CASE form WHEN '{PLAIN}' THEN text WHEN '{SPM}' THEN '{S}' || suffix || '{P}' || prefix || '{M}' || middle
                          ELSE '{P}' || prefix || '{S}' || suffix || '{M}' || middle END AS output FROM p)
SELECT doc_id, n, form, CASE WHEN form <> '{PLAIN}' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> '{PLAIN}' THEN length(middle) END AS middle_chars, sha256(output) AS output_sha256, sha256(text) AS restored_sha256
FROM o"""
