"""Secret scan over an incremental blob ledger (DataFrame functions only).

Every historical version of every path is content-addressed (SHA-256 of its text). Only
(blob, rule version) pairs that the ledger has not seen are scanned, each blob once however
many paths and versions hold it, and findings are joined back to all of those paths.

Semantics. A null text is an empty one (a blob like any other). Matches of one kind are
leftmost and do not overlap; those of different kinds may. Positions are code points, end
exclusive. Repeated rows stay repeated; other columns of the input are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import skewed_join

#: Matches that are put in place together.
RUN = 200
FINDING = "struct<start:int,ord:int,kind:string,end:int>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds; a match stays if group ``group`` has ``at_least`` code points. ``version`` keys the ledger."""

    kind: str
    pattern: str
    version: str
    group: int = 0
    at_least: int = 1


#: The three base kinds. hex and access demand their length in the pattern, which
#: finds the same spans, since a longer run starts no later; assign must filter afterwards.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "1", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", "1"),
    Rule("hex", r"[0-9a-f]{32,}", "1"),
)
#: What the scan adds to them.
EXTRA_RULES = (
    # From the first line to the last one, or what follows of the key if there is none.
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[A-Za-z0-9+/=:,\s-]*?-----END [A-Z ]{0,40}PRIVATE KEY-----|[A-Za-z0-9+/=\r\n]*)", "2"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "1"),
)
RULES = BASE_RULES + EXTRA_RULES


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """All findings of one rule, as an array of FINDING.

    The matches and the gaps between them come from two passes of the same pattern; their
    lengths add up to the positions. Texts without a match cost one pass and no arrays.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    each = F.zip_with(
        F.slice(gaps, 1, F.size(found)),
        found,
        lambda g, m: F.struct(
            F.length(g).alias("gap"),
            F.length(m).alias("len"),
            (F.length(F.regexp_extract(m, rule.pattern, rule.group)) >= rule.at_least if rule.group else F.lit(True)).alias("ok"),
        ),
    )
    empty = F.array().cast(f"array<{FINDING}>")

    def walked(start: Column, rows: Column) -> Column:
        return F.aggregate(
            rows,
            F.struct(start.alias("at"), empty.alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["len"]).alias("at"),
                F.when(
                    x["ok"],
                    F.array_append(
                        acc["out"],
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            F.lit(order).alias("ord"),
                            F.lit(rule.kind).alias("kind"),
                            (acc["at"] + x["gap"] + x["len"]).alias("end"),
                        ).cast(FINDING),
                    ),
                )
                .otherwise(acc["out"])
                .alias("out"),
            ),
            lambda acc: acc["out"],
        )

    # An append copies the array, so matches go RUN at a time: first where each run begins, then the runs.
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(each) - 1) / RUN).cast("int"))), lambda i: F.slice(each, i * RUN + 1, RUN))
    placed = F.aggregate(
        runs,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,rows:array<struct<gap:int,len:int,ok:boolean>>>>").alias("out")),
        lambda acc, run: F.struct(
            F.aggregate(run, acc["at"], lambda at, x: at + x["gap"] + x["len"]).alias("at"),
            F.array_append(acc["out"], F.struct(acc["at"].alias("at"), run.alias("rows"))).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    found_all = F.flatten(F.transform(placed, lambda p: walked(p["at"], p["rows"])))
    return F.when(text.rlike(rule.pattern), found_all).otherwise(empty)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, findings) for ``blobs(blob, text)``; findings ordered by start, then rule order."""
    parts = [spans(F.col("text"), r, i) for i, r in enumerate(rules)]
    return blobs.select("blob", F.array_sort(F.concat(*parts)).alias("findings"))


def known_findings(
    blobs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES
) -> tuple[DataFrame, DataFrame]:
    """(findings of ``blobs(blob, text)`` that have any: blob, findings; the ledger's new rows).

    ``ledger(blob, kind, version, findings)`` holds what earlier runs have scanned. A rule whose version
    is in the ledger for a blob is not run on it again; its findings are read there. Of the ledger
    only the rows of these blobs and rule versions are aggregated.
    """
    if ledger is None:
        scanned = scan_blobs(blobs, rules)
        return scanned.filter(F.size("findings") > 0), _ledger_rows(scanned, rules)
    done = ledger.filter(F.concat_ws(":", "kind", "version").isin([f"{r.kind}:{r.version}" for r in rules]))
    done = done.join(blobs.select("blob").hint("merge"), "blob", "left_semi")
    seen = done.groupBy("blob").agg(F.collect_set("kind").alias("seen"))
    todo = blobs.join(seen.hint("merge"), "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    todo = todo.filter(F.size("seen") < len(rules))
    none = F.array().cast(f"array<{FINDING}>")
    parts = [F.when(F.array_contains("seen", r.kind), none).otherwise(spans(F.col("text"), r, i)) for i, r in enumerate(rules)]
    scanned = todo.select("blob", "seen", F.array_sort(F.concat(*parts)).alias("findings"))
    order = F.create_map(*[F.lit(v) for i, r in enumerate(rules) for v in (r.kind, i)])
    old = done.select("blob", F.transform("findings", lambda x: F.struct(x["start"], order[x["kind"]], x["kind"], x["end"]).cast(FINDING)).alias("findings"))
    known = scanned.select("blob", "findings").union(old).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("findings"))).alias("findings"))
    return known.filter(F.size("findings") > 0), _ledger_rows(scanned, rules, F.col("seen"))


def scan_versions(
    versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES
) -> tuple[DataFrame, DataFrame]:
    """Scan ``versions(path, text)`` (one row per historical version) against ``ledger``.

    Returns (findings per version row: path, blob, findings; the ledger's new rows).
    """
    rows = versions.select("path", blob_id(F.col("text")).alias("blob"))
    blobs = versions.select(blob_id(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    hits, fresh = known_findings(blobs, ledger, rules)
    joined = skewed_join(rows, hits, "blob", [F.col("path")], "left")
    empty = F.array().cast(f"array<{FINDING}>")
    return joined.select("path", "blob", F.coalesce("findings", empty).alias("findings")), fresh


def _of_kind(kind: str) -> Column:
    return F.filter("findings", lambda x: x["kind"] == kind)


def _ledger_rows(scanned: DataFrame, rules: tuple[Rule, ...], seen: Column | None = None) -> DataFrame:
    """One row per (blob, rule version) scanned now, findings or none."""
    each = [
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), _of_kind(r.kind).alias("findings"))
        for r in rules
    ]
    rows = scanned.select("blob", F.explode(F.array(*each)).alias("r"), *([seen.alias("seen")] if seen is not None else []))
    if seen is not None:
        rows = rows.filter(~F.array_contains("seen", F.col("r.kind")))
    return rows.select("blob", "r.kind", "r.version", "r.findings")


def joined_spans(findings: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(text: Column, findings: Column, mark: str = "[secret]") -> Column:
    """The text with every finding (merged where they overlap) replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    walked = F.aggregate(
        findings,
        start,
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(
                x["start"] >= acc["at"],
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark)),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(findings) == 0, text).otherwise(walked)


def redact_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]", ledger: DataFrame | None = None) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced, and ``n_chars``, if there, counted again.

    Each blob is scanned once, or read from ``ledger``; its findings go back to all its rows. A text
    without findings stays as it is, null included.
    """
    # The row travels as one struct, so no column of the input can clash with those used here.
    rows = docs.select(F.struct("*").alias("row"), blob_id(F.col("text")).alias("blob"))
    blobs = rows.select("blob", F.coalesce("row.text", F.lit("")).alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    hits, _ = known_findings(blobs, ledger, rules)
    joined = skewed_join(rows, hits, "blob", [F.col("row.doc_id")], "left")
    found = F.coalesce("findings", F.array().cast(f"array<{FINDING}>"))
    changed = {"text": redact(F.col("row.text"), found, mark)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size(found) > 0, F.length(changed["text"]).cast("long")).otherwise(F.col("row.n_chars"))
    return joined.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
