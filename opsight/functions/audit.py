"""Scoring and classification of audit entries and resources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from opsight.functions.scalar import case_ladder, col, contains_any, lookup

# Points per keyword found in a method name.
METHOD_KEYWORDS = {
    "setiampolicy": 40,
    "createiam": 25,
    "createserviceaccountkey": 50,
    "deleteserviceaccountkey": 30,
    "generateaccesstoken": 35,
    "signblob": 30,
    "signjwt": 30,
    "updatefunction": 20,
    "createexecution": 15,
    "delete": 20,
    "patch": 10,
    "update": 10,
}

# Points per token found in a resource name.
RESOURCE_TOKENS = {
    "prod": 20,
    "production": 20,
    "raw": 15,
    "secret": 25,
    "secrets": 25,
    "iam": 20,
    "security": 20,
    "confidential": 20,
}

# Domain of each service host.
SERVICE_DOMAINS = {
    "bigquery.googleapis.com": "BIGQUERY",
    "storage.googleapis.com": "STORAGE",
    "aiplatform.googleapis.com": "VERTEX_AI",
    "pubsub.googleapis.com": "PUBSUB",
    "cloudfunctions.googleapis.com": "CLOUD_FUNCTIONS",
    "workflows.googleapis.com": "WORKFLOWS",
    "iam.googleapis.com": "IAM",
    "cloudresourcemanager.googleapis.com": "RESOURCE_MANAGER",
    "logging.googleapis.com": "LOGGING",
}


def _weights(weights: dict[str, int]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("p")) for k, v in weights.items()])


def keyword_hits(c: Column | str, weights: dict[str, int]) -> Column:
    """Keywords present in the lowercased text, in table order; overlapping words all count."""
    text = F.lower(F.coalesce(col(c), F.lit("")))
    return F.filter(_weights(weights), lambda w: F.contains(text, w["k"]))


def keyword_score(c: Column | str, weights: dict[str, int]) -> Column:
    return F.aggregate(keyword_hits(c, weights), F.lit(0), lambda acc, w: acc + w["p"])


def keyword_reasons(c: Column | str, weights: dict[str, int], prefix: str) -> Column:
    return F.transform(keyword_hits(c, weights), lambda w: F.concat(F.lit(prefix), w["k"]))


def classify_environment(resource: Column | str) -> Column:
    r = col(resource)
    return case_ladder(
        [
            (r.isNull() | (r == ""), "unknown"),
            (contains_any(r, ["prod", "production"]), "prod"),
            (contains_any(r, ["dev", "test", "uat", "lab", "sandbox"]), "dev"),
        ],
        "unknown",
    )


def classify_principal(principal: Column | str) -> Column:
    p = col(principal)
    return case_ladder(
        [
            (p.isNull() | (p == ""), "UNKNOWN"),
            (p.startswith("service-") & p.contains("gcp-sa-"), "SERVICE_AGENT"),
            (p.endswith(".gserviceaccount.com"), "SERVICE_ACCOUNT"),
            (p.contains("@"), "USER"),
            (p.startswith("principal://") | p.startswith("principalSet://"), "FEDERATED"),
        ],
        "OTHER",
    )


def service_domain(host: Column | str) -> Column:
    return lookup(host, SERVICE_DOMAINS, "OTHER")
