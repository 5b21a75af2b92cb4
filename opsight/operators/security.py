"""Access behaviour anomalies, audit-entry risk and protected events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.audit import (
    METHOD_KEYWORDS,
    RESOURCE_TOKENS,
    classify_principal,
    keyword_reasons,
    keyword_score,
    service_domain,
)
from opsight.functions.scalar import as_int, case_ladder, contains_any, is_true, lookup, to_int_or
from opsight.functions.text import (
    finding_counts,
    first_match,
    mask_ip,
    protect_text,
    protection_action,
    pseudonym,
    risk_points,
)
from opsight.operators.joins import join_baseline, novelty_flag

# Points of each sensitive method.
SENSITIVE_METHODS = {
    "google.iam.admin.v1.SetIamPolicy": 35,
    "google.iam.admin.v1.CreateServiceAccountKey": 45,
    "google.iam.credentials.v1.GenerateAccessToken": 30,
    "google.cloud.functions.v2.UpdateFunction": 20,
    "google.cloud.workflows.executions.v1.CreateExecution": 15,
    "google.cloud.aiplatform.v1.Endpoint.Predict": 8,
}
# Resource words, and the registered service accounts unless a caller names others.
SENSITIVE_RESOURCES = ("prod", "security", "raw", "iam", "secrets")
KNOWN_ACCOUNTS = ("sa-aiops-dataflow", "sa-aiops-training", "sa-aiops-remediation", "sa-aiops-monitoring")


def access_features(df: DataFrame, accounts: Sequence[str] = KNOWN_ACCOUNTS) -> DataFrame:
    """Flags of an access event; ``accounts`` are parts of the names of registered service accounts."""
    hour = F.hour("event_ts")
    known = F.lit(False)
    for prefix in accounts:
        known = known | F.col("principal").contains(prefix)
    return df.withColumns(
        {
            "is_denied": is_true(to_int_or("status_code") == 7),
            "is_sensitive_method": is_true(F.col("method_name").isin(*SENSITIVE_METHODS)),
            "method_points": lookup("method_name", SENSITIVE_METHODS, 0),
            "is_sensitive_resource": contains_any("resource_name", SENSITIVE_RESOURCES),
            "is_off_hours": ~hour.between(8, 19),
            "is_unknown_account": is_true(F.col("principal").startswith("serviceAccount:") & ~known),
        }
    )


def hourly_baseline(df: DataFrame, cutoff: Column, out: str = "baseline_event_count") -> DataFrame:
    """Median events per active hour of each principal before the cutoff.

    Events are counted per hour on the map side first; a principal's series is then at most
    one row per hour.
    """
    hourly = (
        df.filter(F.col("event_ts") < cutoff)
        .groupBy("principal", F.date_trunc("hour", "event_ts").alias("_h"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return hourly.groupBy("principal").agg(F.percentile("_n", F.lit(0.5)).alias(out))


def principal_window(df: DataFrame) -> DataFrame:
    """Counts of one window per principal."""
    n = lambda c: F.sum(as_int(F.col(c)))
    return df.groupBy("principal").agg(
        F.count(F.lit(1)).alias("event_count"),
        n("is_denied").alias("denied_count"),
        n("is_sensitive_method").alias("sensitive_method_count"),
        n("is_sensitive_resource").alias("sensitive_resource_count"),
        n("is_off_hours").alias("off_hours_count"),
        n("is_novel_method").alias("novelty_count"),
        F.sum("method_points").alias("method_points"),
        F.bool_or("is_unknown_account").alias("unknown_account"),
    )


def behavior_anomalies(df: DataFrame, minimum: int = 15) -> DataFrame:
    """Principals whose latest hour departs from their own history."""
    start = df.agg(F.date_trunc("hour", F.max("event_ts")).alias("c")).scalar()
    events = access_features(df)
    current, past = events.filter(F.col("event_ts") >= start), events.filter(F.col("event_ts") < start)
    flagged = novelty_flag(current, past, ["principal", "method_name"], "is_novel_method")
    profile = join_baseline(
        principal_window(flagged), hourly_baseline(df, start), ["principal"], "baseline_event_count"
    )
    ratio = F.col("event_count") / F.greatest("baseline_event_count", F.lit(1.0))
    c = F.col
    signals = [
        (c("volume_ratio") >= 5, F.lit(20), F.concat(F.lit("volume "), F.format_string("%.1f", "volume_ratio"), F.lit("x"))),
        (c("denied_count") >= 10, F.least(F.lit(30), "denied_count"),
         F.concat(c("denied_count").cast("string"), F.lit(" denied"))),
        (c("sensitive_method_count") > 0, c("method_points"),
         F.concat(c("sensitive_method_count").cast("string"), F.lit(" sensitive methods"))),
        (c("sensitive_resource_count") > 0, F.least(F.lit(20), c("sensitive_resource_count") * 4),
         F.concat(c("sensitive_resource_count").cast("string"), F.lit(" sensitive resources"))),
        (c("off_hours_count") > 0, F.least(F.lit(10), c("off_hours_count") * 2),
         F.concat(c("off_hours_count").cast("string"), F.lit(" off hours"))),
        (c("novelty_count") > 0, F.least(F.lit(15), c("novelty_count") * 3),
         F.concat(c("novelty_count").cast("string"), F.lit(" new methods"))),
        (c("unknown_account"), F.lit(25), F.lit("unregistered service account")),
    ]
    score = sum((F.when(is_true(cond), pts).otherwise(0) for cond, pts, _ in signals), F.lit(0))
    reasons = F.concat_ws("; ", *[F.when(is_true(cond), why) for cond, _, why in signals])
    s = c("risk_score")
    return (
        profile.withColumn("volume_ratio", ratio)
        .withColumns({"risk_score": score.cast("bigint"), "reasons": reasons})
        .withColumn("severity", case_ladder([(s >= 70, "HIGH"), (s >= 35, "MEDIUM"), (s >= 15, "LOW")], "INFO"))
        .withColumn(
            "recommended_action",
            case_ladder([(s >= 70, "open_incident_and_review_access"), (s >= 35, "review_on_dashboard"),
                         (s >= 15, "record_weak_signal")], "none"),
        )
        .filter(s >= minimum)
        .withColumns({"window_start": start, "window_end": start + F.expr("INTERVAL 1 HOUR")})
        .drop("method_points")
    )


AUDIT_ENTRY = (
    "timestamp string, logName string, protoPayload struct<authenticationInfo: struct<principalEmail: string>, "
    "requestMetadata: struct<callerIp: string, callerSuppliedUserAgent: string>, status: struct<code: int, "
    "message: string>, serviceName: string, methodName: string, resourceName: string, "
    "authorizationInfo: array<struct<permission: string, granted: boolean>>>"
)


def audit_level(score: Column) -> Column:
    return case_ladder([(score >= 75, "HIGH"), (score >= 40, "MEDIUM"), (score >= 15, "LOW")], "INFO")


def audit_risk(df: DataFrame) -> DataFrame:
    """Flat, scored audit entries from the nested log shape; other columns pass through."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    p = "protoPayload."
    none = F.array().cast("array<struct<permission:string,granted:boolean>>")
    granted = F.coalesce(F.col(p + "authorizationInfo"), none)
    named = F.filter(granted, lambda a: a["permission"].isNotNull() & (a["permission"] != ""))
    unique = lambda arr: F.array_sort(F.array_distinct(F.transform(arr, lambda a: a["permission"])))
    flat = df.withColumns(
        {
            "_principal": blank(p + "authenticationInfo.principalEmail"),
            "service_name": blank(p + "serviceName"),
            "method_name": blank(p + "methodName"),
            "resource_name": blank(p + "resourceName"),
            "status_code": F.coalesce(F.col(p + "status.code"), F.lit(0)),
            "status_message": blank(p + "status.message"),
            "caller_ip": blank(p + "requestMetadata.callerIp"),
            "user_agent": blank(p + "requestMetadata.callerSuppliedUserAgent"),
            "_all": unique(named),
            "_denied": unique(F.filter(named, lambda a: a["granted"] == F.lit(False))),
        }
    )
    method, kind = F.lower("method_name"), classify_principal("_principal")
    denied = F.size("_denied")
    rules = [
        (F.col("status_code") == 7, F.lit(25), "PERMISSION_DENIED"),
        (denied > 0, F.least(F.lit(20), denied * 5), "denied permissions"),
        ((kind == "SERVICE_ACCOUNT") & (method.contains("iam") | method.contains("setiampolicy")), F.lit(25),
         "service account runs IAM operation"),
        (F.col("service_name") == "iam.googleapis.com", F.lit(10), "IAM service"),
        ((F.col("service_name") == "aiplatform.googleapis.com") & method.contains("delete"), F.lit(20),
         "deletes AI resource"),
    ]
    points = [F.when(c, v).otherwise(0) for c, v, _ in rules]
    why = [F.array_compact(F.array(F.when(c, F.lit(r)))) for c, _, r in rules]
    score = sum(points, keyword_score("method_name", METHOD_KEYWORDS) + keyword_score("resource_name", RESOURCE_TOKENS))
    reasons = F.concat(
        why[0],
        keyword_reasons("method_name", METHOD_KEYWORDS, "method: "),
        keyword_reasons("resource_name", RESOURCE_TOKENS, "resource: "),
        *why[1:],
    )
    return flat.withColumns(
        {
            "principal": F.when(F.col("_principal") == "", "UNKNOWN").otherwise(F.col("_principal")),
            "principal_type": kind,
            "service_domain": service_domain("service_name"),
            "permissions": F.array_join("_all", ";"),
            "denied_permissions": F.array_join("_denied", ";"),
            "risk_score": F.least(score, F.lit(100)),
            "reasons": F.array_join(reasons, "; "),
        }
    ).withColumn("risk_level", audit_level(F.col("risk_score"))).drop("_principal", "_all", "_denied", "protoPayload")


def audit_report(df: DataFrame, dims: Sequence[str] = ("risk_level", "service_domain", "principal")) -> DataFrame:
    """Event counts along each dimension from one pass."""
    sets = df.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]).agg(
        F.count(F.lit(1)).alias("events"), F.grouping_id().alias("_g")
    )
    code = {2 ** len(dims) - 1 - 2 ** (len(dims) - 1 - i): d for i, d in enumerate(dims)}
    return sets.select(
        case_ladder([(F.col("_g") == g, d) for g, d in code.items()]).alias("dimension"),
        case_ladder([(F.col("_g") == g, F.col(d)) for g, d in code.items()]).alias("member"),
        "events",
    )


def denied_events(df: DataFrame, ts: str, tiebreak: str, k: int = 20) -> DataFrame:
    return df.filter(F.col("status_code") == 7).orderBy(F.desc(ts), tiebreak).limit(k)


def riskiest_events(df: DataFrame, tiebreak: str, k: int = 25) -> DataFrame:
    return (
        df.filter(F.col("risk_level").isin("HIGH", "MEDIUM")).orderBy(F.desc("risk_score"), tiebreak).limit(k)
    )


def protect_events(df: DataFrame, text: str, salt: str) -> DataFrame:
    """Masked message, pseudonymous user, finding counts, risk and action of a message."""
    ip = first_match(text, "ip")
    return df.withColumns(
        {
            "user_hash": pseudonym(first_match(text, "email"), salt),
            "source_ip_masked": mask_ip(ip),
            "original_length": F.length(text),
            "protected_message": protect_text(text),
            "risk_score": risk_points(text),
            **finding_counts(text),
        }
    ).withColumn("protection_action", protection_action("risk_score"))


def protection_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("risk_score") >= 3).alias("relevant"),
        F.count_if(F.col("protection_action") == "REDACT_AND_ALERT").alias("alerts"),
    )
