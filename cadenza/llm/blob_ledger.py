"""Secret scans with an incremental blob ledger.

Every version of a document is addressed by its content: its blob is the
SHA-256 of its text. The ledger (a Parquet table in shared storage) has a row
for each scan of a blob: the rule versions applied and what they found. A run
scans only pairs of blob and rule version that the ledger lacks, each blob
once whatever its number of paths, appends the result, and joins findings
back to all paths that hold the blob. A new rule or a new version of one rule
makes only those pairs due.

Defined results: null text as the empty blob; repeated rows each get their
row; a null doc_id is a path like others; several versions under one doc_id
are scanned each; findings of one kind don't overlap, of several kinds may;
an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import fresh, map_blocks, texts
from cadenza.session import ensure_checkpoint_dir, materialize


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``, dropped if ``group`` is shorter than ``least``."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    either_case: bool = False
    base: bool = False
    span: int = 0  # the group that is the finding; a match without it is none

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def find(self, text: str) -> list[tuple[int, int]]:
        compiled = re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.either_case else 0))
        return [m.span(self.span) for m in compiled.finditer(text) if m.start(self.span) >= 0 and m.end(self.group) - m.start(self.group) >= self.least]


#: A private key from its BEGIN line to its END line; where that is missing, over the header and base64 lines that follow.
_PEM = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    r"(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]*PRIVATE KEY-----"
    r"|(?:(?:\s|\\[nr])+(?:Proc-Type|DEK-Info):[^\n\\]*+)*+(?:(?:\s|\\[nr])++[A-Za-z0-9+/]{16,}+={0,2})++(?:(?:\s|\\[nr])++[A-Za-z0-9+/]{1,15}+={0,2}(?![^\s\\\"']))?"
    r")?"
)
#: From the first eyJ of a run on; where that doesn't do, no later one of the run does, so the run is passed over at once.
_JWT = r"(?:(?!eyJ)[A-Za-z0-9_-])*+(eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)|[A-Za-z0-9_-]++"
#: The base kinds in their listed order, then the kinds added here.
RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6, either_case=True, base=True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", 1, r"[0-9a-f]+", least=24, base=True),
    Rule("pem", 2, _PEM),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", 1, _JWT, span=1),
)
LEDGER = "blob binary, rules array<string>, findings array<struct<rule:string,start:int,stop:int>>"
SECRET = "[SECRET]"


def blob(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def scan_text(text: str, rules: Sequence[Rule]) -> list[dict]:
    """Findings of one text, by start, then rule order (code points, stop exclusive)."""
    found = [(a, i, b) for i, rule in enumerate(rules) for a, b in rule.find(text)]
    return [{"rule": rules[i].key, "start": a, "stop": b} for a, i, b in sorted(found)]


def new_ledger(spark: SparkSession, path: str | None = None) -> str:
    """An empty ledger (below the shared checkpoint folder unless told where)."""
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return path


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def due(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob, owner, rules``: blobs with rule versions the ledger lacks, and one path that holds each."""
    blobs = versions.groupBy("blob").agg(F.min("doc_id").alias("owner"))
    done = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    rest = F.array_except(wanted, F.coalesce(F.col("done"), F.array().cast("array<string>")))
    return blobs.join(done, "blob", "left").withColumn("rules", rest).where(F.size("rules") > 0).select("blob", "owner", "rules")


def scan_unseen(docs: DataFrame, path: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Bring the ledger at ``path`` up to date with ``docs``; returns ``doc_id, blob`` of every version."""
    spark = docs.sparkSession
    held = texts(docs).withColumn("blob", blob(F.col("text")))
    versions = materialize(held.select("doc_id", "blob"))
    todo = due(versions, read_ledger(spark, path), rules)
    on = held["blob"] == todo["blob"]
    rows = held.join(todo.hint("shuffle_hash"), on & held["doc_id"].eqNullSafe(todo["owner"])).select(held["blob"], "text", "rules")
    by_key = {r.key: r for r in rules}

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column("rules").to_pylist()
        found = [scan_text(t, [r for k, r in by_key.items() if k in own]) for t, own in zip(batch.column("text").to_pylist(), keys)]
        kind = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        return pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(keys, pa.list_(pa.string())), pa.array(found, kind)], ["blob", "rules", "findings"])

    # A repeated row has been scanned with its copy; the ledger takes one.
    map_blocks(rows, block, LEDGER).dropDuplicates(["blob"]).write.mode("append").parquet(path)
    return versions


def findings(versions: DataFrame, path: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id, blob, findings`` of every path, from the ledger: those of the current rule versions."""
    current = [r.key for r in rules]
    held = read_ledger(versions.sparkSession, path).select("blob", F.filter("findings", lambda f: f["rule"].isin(current)).alias("findings")).where(F.size("findings") > 0)
    # A blob has a ledger row per scan (as many as rule sets it met), so its findings are few.
    held = held.groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("findings"))
    return versions.join(held, "blob", "left").select("doc_id", "blob", F.coalesce("findings", F.array().cast("array<struct<rule:string,start:int,stop:int>>")).alias("findings"))


def span_digests(found: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    kinds = F.create_map(*[x for r in rules for x in (F.lit(r.key), F.lit(r.kind))])
    ranked = F.array_sort(F.transform("findings", lambda f: F.struct(f["start"].alias("start"), order[f["rule"]].alias("place"), f["stop"].alias("stop"), kinds[f["rule"]].alias("kind"))))
    found = found.withColumn("f", ranked)
    base = [r.kind for r in rules if r.base]
    joined = lambda rows: F.concat_ws(",", F.transform(rows, lambda f: F.concat_ws(":", f["kind"], f["start"], f["stop"])))
    count = lambda kind: F.size(F.filter("f", lambda f: f["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(joined(F.filter("f", lambda f: f["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("f")).alias("spans"),
    )


def secret_scan(docs: DataFrame, path: str | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id, blob, findings`` of every row, scanning only what the ledger at ``path`` lacks."""
    path = new_ledger(docs.sparkSession, path)
    return findings(scan_unseen(docs, path, rules), path, rules)


def redact(docs: DataFrame, path: str | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with every finding replaced by ``[SECRET]`` and, where that changed a text, ``n_chars`` of the new one."""
    path = new_ledger(docs.sparkSession, path)
    found = findings(scan_unseen(docs, path, rules).select("blob", F.lit(0).alias("doc_id")).distinct(), path, rules)
    # Columns of ours get names that the documents don't have.
    blob_, spans, merged, clean = (fresh(docs, c) for c in ("found_blob", "found_spans", "found_merged", "found_clean"))
    found = found.where(F.size("findings") > 0).select(F.col("blob").alias(blob_), F.transform("findings", lambda f: F.struct(f["start"].alias("start"), f["stop"].alias("stop"))).alias(spans))
    rows = docs.join(found, blob(F.col("text")) == F.col(blob_), "left")
    # Overlapping spans become one; then the last goes first, so earlier places stay right.
    one = F.expr(
        f"aggregate(array_sort({spans}), cast(array() as array<struct<start:int,stop:int>>), (m, s) -> "
        "if(size(m) > 0 and s.start < element_at(m, -1).stop, "
        "concat(slice(m, 1, size(m) - 1), array(named_struct('start', element_at(m, -1).start, 'stop', greatest(element_at(m, -1).stop, s.stop)))), "
        "concat(m, array(s))))"
    )
    rows = rows.withColumn(merged, F.when(F.col(spans).isNotNull(), F.reverse(one)))
    masked = F.expr(f"aggregate({merged}, text, (t, s) -> overlay(t placing '{SECRET}' from s.start + 1 for s.stop - s.start))")
    rows = rows.withColumn(clean, F.when(F.col(merged).isNull(), F.col("text")).otherwise(masked))
    changes = {"text": F.col(clean)}
    if "n_chars" in docs.columns:
        changes["n_chars"] = F.when(F.col(merged).isNull(), F.col("n_chars")).otherwise(F.length(clean)).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changes[c].alias(c) if c in changes else F.col(f"`{c}`") for c in docs.columns])


def base_digest(text: str, rules: Sequence[Rule] = RULES) -> str:
    """The digest of one text's base spans, for checks."""
    kinds = {r.key: r.kind for r in rules if r.base}
    return hashlib.sha256(",".join(f"{kinds[f['rule']]}:{f['start']}:{f['stop']}" for f in scan_text(text, rules) if f["rule"] in kinds).encode()).hexdigest()
