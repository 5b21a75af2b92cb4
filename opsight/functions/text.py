"""Sensitive-data detection, masking, log templates, tags and chunking as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from opsight.functions.scalar import case_ladder, col, strip

# What counts as sensitive, and the points of each kind.
PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "ip": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "bearer_token": r"(?i)\bBearer\s+[A-Za-z0-9._\-+/=]+",
    "password": r"(?i)\b(password|passwd|pwd)\s*=\s*[^&\s,;]+",
    "api_key_or_secret": r"(?i)\b(api[_-]?key|x-api-key|client_secret|secret)\s*[:=]\s*[^&\s,;]+",
    "jwt": r"\beyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+\b",
}
RISK_POINTS = {"email": 2, "ip": 1, "bearer_token": 5, "password": 5, "api_key_or_secret": 5, "jwt": 5}

# One pass over the address: first and last letter of the local part, then the domain. A local
# part of one or two letters leaves the second group empty.
LOCAL = r"[A-Za-z0-9._%+\-]"
EMAIL_PARTS = rf"\b({LOCAL})(?:{LOCAL}?|{LOCAL}+({LOCAL}))@([A-Za-z0-9.-]+\.[A-Za-z]{{2,}})\b"
IP_PARTS = r"\b(\d{1,3}\.\d{1,3})\.\d{1,3}\.\d{1,3}\b"

# Replacements applied in this order, secrets before addresses.
MASKS = (
    (PATTERNS["bearer_token"], "Bearer [REDACTED]"),
    (PATTERNS["jwt"], "[JWT_REDACTED]"),
    (PATTERNS["password"], "$1=[REDACTED]"),
    (PATTERNS["api_key_or_secret"], "$1=[REDACTED]"),
    (EMAIL_PARTS, "$1***$2@$3"),
    (IP_PARTS, "$1.x.x"),
)

# Placeholders used before a text leaves the platform.
REDACTIONS = (
    (r"(?i)(authorization:\s*bearer\s+)[A-Za-z0-9._\-]+", "$1[REDACTED_TOKEN]"),
    (r"(?i)(api[_-]?key=)[A-Za-z0-9._\-]+", "$1[REDACTED_API_KEY]"),
    (r"(?i)(password=)[^&\s]+", "$1[REDACTED_PASSWORD]"),
    (r"\b[\w\.-]+@[\w\.-]+\.\w+\b", "[REDACTED_EMAIL]"),
)

# Variable parts of a log line and their placeholders, in this order.
TEMPLATES = (
    (r"(?i)\btrace[_-]?id[=:][A-Za-z0-9._\-]+", "trace_id=<TRACE_ID>"),
    (r"(?i)\brequest[_-]?id[=:][A-Za-z0-9._\-]+", "request_id=<REQUEST_ID>"),
    (r"\b\d{4}-\d{2}-\d{2}T[^\s]+", "<TIMESTAMP>"),
    (r"\b\d{6,}\b", "<NUMBER>"),
    (r"\blatency_ms=\d+\b", "latency_ms=<NUMBER>"),
    (r"\bstatus=\d{3}\b", "status=<STATUS>"),
)
TEMPLATE_CHARS = 500

# Literals without which a pattern cannot match; most texts lack them and skip the regex.
NEEDLES = {
    PATTERNS["jwt"]: "eyJ",
    EMAIL_PARTS: "@",
    REDACTIONS[3][0]: "@",
    TEMPLATES[4][0]: "latency_ms=",
    TEMPLATES[5][0]: "status=",
}


def unicode_aware(pattern: str) -> str:
    """Word, digit, space and boundary classes over all of Unicode."""
    return "(?U)" + pattern


def _replace_all(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        c = _replace(c, pattern, replacement)
    return c


def _replace(c: Column, pattern: str, replacement: str) -> Column:
    """Replace, looking first for a literal the pattern cannot match without.

    The one-element transform binds the text to a name, so that testing and replacing do not
    repeat the expression below them.
    """
    regex = unicode_aware(pattern)
    needle = NEEDLES.get(pattern)
    if needle is None:
        return F.regexp_replace(c, regex, replacement)
    bound = F.transform(
        F.array(c),
        lambda x: F.when(F.contains(x, F.lit(needle)), F.regexp_replace(x, regex, replacement)).otherwise(x),
    )
    return F.get(bound, F.lit(0))


def text_of(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def may_match(text: Column, kind: str) -> Column:
    """Whether a text holds what a pattern cannot match without: a search for bytes, which spares most texts the regex.

    No letter outside of ASCII is an upper or lower case of those in ``bearer``; ``k`` and ``s`` have such.
    """
    if kind == "bearer_token":
        return F.contains(F.lower(text), F.lit("bearer"))
    needles = {"email": "@", "ip": ".", "password": "=", "api_key_or_secret": ":=", "jwt": ("eyJ",)}[kind]
    found = [F.contains(text, F.lit(n)) for n in needles]
    return found[0] if len(found) == 1 else found[0] | found[1]


def finding_counts(c: Column | str) -> dict[str, Column]:
    """Number of matches of each kind. The matched secrets themselves are not kept."""
    text = text_of(c)
    return {f"n_{kind}": F.when(may_match(text, kind), F.regexp_count(text, F.lit(unicode_aware(p)))).otherwise(0)
            for kind, p in PATTERNS.items()}


def protect_text(c: Column | str) -> Column:
    return _replace_all(text_of(c), MASKS)


def risk_points(c: Column | str) -> Column:
    score, text = F.lit(0), text_of(c)
    for kind, pattern in PATTERNS.items():
        found = may_match(text, kind) & F.regexp_like(text, F.lit(unicode_aware(pattern)))
        score = score + F.when(found, RISK_POINTS[kind]).otherwise(0)
    return score


def protection_action(score: Column | str) -> Column:
    s = col(score)
    return case_ladder([(s >= 8, "REDACT_AND_ALERT"), (s >= 3, "MASK_AND_REVIEW"), (s > 0, "MASK")], "NONE")


def pseudonym(value: Column | str, salt: str, length: int = 16) -> Column:
    """Salted hash of a normalised identifier; empty stays empty."""
    v = text_of(value)
    digest = F.sha2(F.concat(F.lit(salt + "|"), strip(F.lower(v))), 256)
    return F.when(v == "", "").otherwise(F.substring(digest, 1, length))


def first_match(c: Column | str, kind: str) -> Column:
    return F.regexp_extract(text_of(c), unicode_aware(PATTERNS[kind]), 0)


def mask_ip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), unicode_aware(IP_PARTS), "$1.x.x")


def redact(c: Column | str) -> Column:
    return _replace_all(col(c), REDACTIONS)


def log_template(c: Column | str) -> Column:
    return F.substring(_replace_all(strip(c), TEMPLATES), 1, TEMPLATE_CHARS)


def infer_tags(c: Column | str, vocabulary: Sequence[str]) -> Column:
    """Vocabulary words contained in the text, sorted."""
    text = F.lower(text_of(c))
    words = F.array(*[F.lit(v) for v in sorted(set(vocabulary))])
    return F.filter(words, lambda w: F.contains(text, F.lower(w)))



def chunk_text(c: Column | str, max_chars: int = 1200, overlap: int = 200) -> Column:
    """Overlapping chunks of a text, packed from its paragraphs.

    A fold over the paragraphs carries the chunks closed so far and the open one. Paragraphs
    longer than a chunk are cut at ``max_chars - overlap`` steps; every chunk but the first
    is prefixed with the tail of the one before.
    """
    step = max_chars - overlap
    trimmed = F.transform(F.split(text_of(c), unicode_aware(r"\n\s*\n")), lambda p: strip(p))
    paragraphs = F.filter(trimmed, lambda p: p != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def closed(state: Column) -> Column:
        return F.when(state["open"] != "", F.concat(state["done"], F.array(state["open"]))).otherwise(state["done"])

    def pieces(p: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.length(p) - 1) / step).cast("int")),
            lambda i: F.substring(p, i * step + 1, F.lit(max_chars)),
        )

    def add(state: Column, p: Column) -> Column:
        joined = F.when(state["open"] == "", p).otherwise(F.concat(state["open"], F.lit("\n\n"), p))
        fits = F.length(state["open"]) + F.length(p) + 2 <= max_chars
        long = F.length(p) > max_chars
        return F.struct(
            F.when(fits, state["done"])
            .when(long, F.concat(closed(state), pieces(p)))
            .otherwise(closed(state))
            .alias("done"),
            F.when(fits, joined).when(long, F.lit("")).otherwise(p).alias("open"),
        )

    def finish(state: Column) -> Column:
        if overlap <= 0:
            return closed(state)
        # Inside the fold's last step the state is a bound variable: nothing is folded twice.
        return F.transform(
            closed(state),
            lambda chunk, i: F.when(i == 0, chunk).otherwise(
                F.concat(F.right(F.get(closed(state), i - 1), F.lit(overlap)), F.lit("\n\n"), chunk)
            ),
        )

    return F.aggregate(paragraphs, start, add, finish)
