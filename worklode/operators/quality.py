"""Data-quality checks: column validators, row flags, a rule runner and gates."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.operators import joins
from worklode.operators.aggregates import count_where, guarded_ratio


def out_of_range(col: str, low=None, high=None) -> Column:
    """Non-null values outside optional bounds."""
    c, tests = F.col(col), []
    if low is not None:
        tests.append(c < low)
    if high is not None:
        tests.append(c > high)
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def validate_columns(df: DataFrame, checks: dict[str, Column], key: str | None = None) -> DataFrame:
    """One row per check: total, failed, pass rate.  All predicate checks share one aggregate over one
    scan; ``key`` adds a uniqueness check, counted per duplicated key."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"), *[count_where(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()]
    )
    items = F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("failed")) for n in checks]))
    result = counts.select(F.col("_total").alias("total"), items.alias("_i")).select("total", "_i.*")
    if key:
        repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
            F.sum("n").alias("total"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed")
        )
        result = result.unionByName(repeated.select("total", F.lit(f"unique_{key}").alias("check_name"), "failed"))
    return result.withColumn("pass_rate", guarded_ratio(F.col("total") - F.col("failed"), F.col("total")))


def flag_rows(df: DataFrame, checks: dict[str, tuple[str, Column]]) -> DataFrame:
    """Per check a PASS / WARN / FAIL column, the failed check names, and the worst status.

    ``checks`` = {name: (status when hit, condition)}.
    """
    flags = {f"dq_{n}": F.when(F.coalesce(cond, F.lit(False)), level).otherwise("PASS") for n, (level, cond) in checks.items()}
    flagged = df.withColumns(flags)
    statuses = F.array(*[F.col(c) for c in flags])
    failed = F.filter(F.array(*[F.when(F.col(f"dq_{n}") != "PASS", F.lit(n)) for n in checks]), lambda c: c.isNotNull())
    worst = F.when(F.array_contains(statuses, "FAIL"), "FAIL").when(F.array_contains(statuses, "WARN"), "WARN").otherwise("PASS")
    return flagged.withColumns({"failed_rules": failed, "dq_overall_status": worst})


def batch_metrics(flagged: DataFrame, batch: str) -> DataFrame:
    """Pass, warn and fail counts and the pass rate of every batch in one aggregate."""
    counts = flagged.groupBy(batch).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[count_where(F.col("dq_overall_status") == s).alias(f"{s.lower()}_rows") for s in ("PASS", "WARN", "FAIL")],
    )
    return counts.withColumn("pass_rate", guarded_ratio(F.col("pass_rows"), F.col("total_rows")))


@dataclass(frozen=True)
class Rule:
    """A rule as data.  ``kind`` says how ``spec`` is evaluated (see ``run_rules``)."""

    name: str
    category: str
    severity: str
    table: str
    kind: str
    spec: dict = field(default_factory=dict)


def _entry(rule: Rule, key: Column | None, when: Column, met: Column | bool, rows: int = 1) -> Column:
    """One row's part in a rule, or null if it has none."""
    return F.when(when, F.struct(
        F.lit(rule.name).alias("rule_name"), F.lit(rule.kind).alias("kind"),
        (F.lit(None).cast("array<string>") if key is None else key).alias("key"),
        F.lit(rows).cast("long").alias("rows"), (met if isinstance(met, Column) else F.lit(met)).alias("met"),
    ))


def _present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _as_key(df: DataFrame, columns: list[str], other: DataFrame, other_columns: list[str]) -> tuple[Column, Column]:
    """Key columns of two tables as texts of the type that an equality of the two would compare."""
    shared = df.select(*columns).limit(0).union(other.select(*other_columns).limit(0)).schema
    return tuple(
        F.array(*[F.col(c).cast(f.dataType).cast("string") for c, f in zip(names, shared)]) for names in (columns, other_columns)
    )


def rule_entries(tables: dict[str, DataFrame], rules: list[Rule], as_of: str) -> dict[str, list[Column]]:
    """What the rows of each table add to the rules: as the table a rule is about, and as its parent or child."""
    entries: dict[str, list[Column]] = {}
    always = F.lit(True)

    def hit(text: str) -> Column:
        return F.coalesce(F.expr(text), F.lit(False))

    for rule in rules:
        spec, own = rule.spec, entries.setdefault(rule.table, [])
        if rule.kind == "where":
            own.append(_entry(rule, None, hit(spec["bad"]), False))
        elif rule.kind == "unique":
            own.append(_entry(rule, F.array(*[F.col(k).cast("string") for k in spec["keys"]]), _present(spec["keys"]), False))
        elif rule.kind == "fresh":
            limit = F.lit(as_of).cast("timestamp") - F.expr(f"interval {spec['hours']} hours")
            recent = F.coalesce(F.col(spec["at"]).cast("timestamp") >= limit, F.lit(False))
            group = F.array(F.col(spec["per"]).cast("string")) if "per" in spec else None
            own.append(_entry(rule, group, always, recent))
        else:
            if rule.kind == "orphan":
                other, columns, other_columns = spec["parent"], list(spec["on"]), list(spec["on"].values())
                asked = hit(spec["where"]) if "where" in spec else always
            else:
                other, columns, other_columns = spec["child"], [spec["key"]], [spec["child_key"]]
                asked = hit(spec["bad"])
            key, other_key = _as_key(tables[rule.table], columns, tables[other], other_columns)
            own.append(_entry(rule, key, asked & _present(columns), False))
            entries.setdefault(other, []).append(_entry(rule, other_key, _present(other_columns), True, rows=0))
    return entries


def run_rules(tables: dict[str, DataFrame], rules: list[Rule], as_of: str) -> DataFrame:
    """Failed records per rule.

    * ``where``: rows meeting ``spec['bad']``.
    * ``unique``: keys of ``spec['keys']`` that occur more than once.
    * ``orphan``: rows without a parent, or (``any``) without one of several parents.
    * ``used``: rows meeting ``spec['bad']`` that a child still refers to.
    * ``fresh``: 1 if the newest ``spec['at']`` is older than ``spec['hours']`` (or there is none);
      with ``per``, the number of groups that are too old.
    * ``frame``: rows of ``spec['rows'](tables)`` for shapes of their own.

    The first five kinds are one plan, whatever their number: every table is read once and gives entries
    (rule, key, rows, met) for each rule it takes part in, as child or as parent.  Entries are folded per rule
    and key, before the shuffle too, so that neither a hot key nor a predicate sends more than a row per task;
    a key's verdict follows from its sums without a join.  ``any`` and ``frame`` rules have plans of their own.
    """
    folded = [r for r in rules if r.kind != "frame" and "any" not in r.spec]
    parts = []
    for rule in rules:
        if rule in folded:
            continue
        if rule.kind == "orphan":
            bad = joins.orphans_of_any(tables[rule.table], [(tables[p], c, k) for p, c, k in rule.spec["any"]])
        else:
            bad = rule.spec["rows"](tables)
        parts.append(bad.agg(F.count(F.lit(1)).alias("failed_records")).select(F.lit(rule.name).alias("rule_name"), "failed_records"))
    if folded:
        scans = [
            tables[name].select(F.explode(F.array(*listed)).alias("_e")).filter("_e is not null").select("_e.*")
            for name, listed in rule_entries(tables, folded, as_of).items()
        ]
        # A rule whose tables are empty still has a verdict, so each one starts with an entry that counts nothing.
        start = F.explode(F.array(*[_entry(r, None, F.lit(True), r.kind == "fresh" and "per" in r.spec, rows=0) for r in folded]))
        scans.append(scans[0].sparkSession.range(1).select(start.alias("_e")).select("_e.*"))
        keys = reduce(lambda a, b: a.unionByName(b), scans).groupBy("rule_name", "kind", "key").agg(
            F.sum("rows").alias("rows"), F.max("met").alias("met")
        )
        failed = (
            F.when(F.col("kind") == "where", F.col("rows"))
            .when(F.col("kind") == "unique", (F.col("rows") > 1).cast("long"))
            .when(F.col("kind") == "orphan", F.when(F.col("met"), 0).otherwise(F.col("rows")))
            .when(F.col("kind") == "used", F.when(F.col("met"), F.col("rows")).otherwise(0))
            .otherwise((~F.col("met")).cast("long"))
        )
        parts.append(keys.groupBy("rule_name").agg(F.sum(failed).alias("failed_records")))
    by_name = {r.name: r for r in rules}
    result = reduce(lambda a, b: a.unionByName(b), parts)

    def attribute(get) -> Column:
        return F.create_map(*[F.lit(x) for r in by_name.values() for x in (r.name, get(r))])[F.col("rule_name")]

    return result.select(
        "rule_name", attribute(lambda r: r.category).alias("rule_category"), attribute(lambda r: r.severity).alias("severity"),
        attribute(lambda r: r.table).alias("target_table"), "failed_records",
    )


def failing_rows(tables: dict[str, DataFrame], rule: Rule) -> DataFrame:
    """The rows behind a ``where`` rule, whole (no list of ids is ever collected)."""
    return tables[rule.table].filter(F.expr(rule.spec["bad"]))


def route_actions(results: DataFrame, actions: dict[str, list[str]]) -> DataFrame:
    """Actions for failed rules by severity; ``actions`` = {severity: [action, ...]}."""
    listed = F.create_map(*[x for s, a in actions.items() for x in (F.lit(s), F.array(*[F.lit(n) for n in a]))])
    failed = results.filter(F.col("failed_records") > 0)
    return failed.select("rule_name", "severity", "failed_records", F.explode(listed[F.col("severity")]).alias("action"))


def publish_gate(previous: DataFrame, current: DataFrame, key: str, rows: str, limits: dict[str, float], default: float) -> DataFrame:
    """Row-count variance of each table against the last published count, against its own limit."""
    p = previous.select(key, F.col(rows).alias("previous_rows"))
    c = current.select(key, F.col(rows).alias("current_rows"))
    limit = F.lit(default)
    for name, value in limits.items():
        limit = F.when(F.col(key) == name, value).otherwise(limit)
    change = F.abs(F.col("current_rows") - F.col("previous_rows")).cast("double") / F.col("previous_rows").cast("double")
    joined = p.join(c, key, "full").fillna(0, ["current_rows"]).withColumn("variance", F.when(F.col("previous_rows") > 0, change))
    verdict = F.when(F.col("previous_rows").isNull(), "NEW").when(F.col("variance") > limit, "BLOCK").otherwise("PASS")
    return joined.withColumn("verdict", verdict)


def sla_verdicts(metrics: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """``metrics`` has (metric, value); ``limits`` = {metric: ('min' or 'max', bound)}."""
    ok = F.lit(None).cast("boolean")
    for name, (side, bound) in limits.items():
        test = F.col("value") >= bound if side == "min" else F.col("value") <= bound
        ok = F.when(F.col("metric") == name, test).otherwise(ok)
    return metrics.withColumn("meets_sla", ok)
