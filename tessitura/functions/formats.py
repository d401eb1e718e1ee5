"""Times, addresses, messages, progress: Column → Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What error messages say, by kind.
RATE_LIMIT = (
    "too many requests",
    "http error 429",
    "status code: 429",
    "sign in to confirm you're not a bot",
    "log in to confirm you're not a bot",
    "confirm you're not a bot",
    "this request has been blocked",
    "temporarily unavailable",
    "rate limit",
)
SKIPPABLE = ("http error 403", "forbidden", "unable to download video data")
NETWORK = (
    "timed out",
    "timeout",
    "connection reset",
    "connection aborted",
    "connection refused",
    "temporary failure in name resolution",
    "name or service not known",
    "tls",
    "ssl",
    "proxy error",
    "proxyconnect",
    "incomplete read",
    "network is unreachable",
    "remote end closed connection",
)
COOKIE = (
    r"\byoutube account cookies? (?:are|is) no longer valid\b",
    r"\bprovided youtube account cookies? (?:are|is) no longer valid\b",
    r"\bcookies? (?:are|is) no longer valid\b",
    r"\bcookies? expired\b",
    r"\bfailed to (?:load|decrypt) cookies?\b",
    r"\bcould not read cookies? file\b",
    r"\bno such file or directory.*cookies?\b",
    r"\bcookies? (?:from browser|database) could not be loaded\b",
)
AUTH = (
    r"\buse --cookies-from-browser or --cookies for the authentication\b",
    r"\bthis video is private\b",
    r"\bprivate video\b",
    r"\bmembers-only\b",
    r"\bjoin this channel to get access\b",
    r"\bconfirm your age\b",
    r"\bage-restricted\b",
)
STEPS = ("validate_urls", "crawl_audio", "vocal_separation", "normalize_audio", "segment_and_label", "build_segment_metadata")


def _says(message: Column, phrases: tuple[str, ...]) -> Column:
    return F.coalesce(F.lower(message).rlike("|".join(f"\\Q{p}\\E" for p in phrases)), F.lit(False))


def _matches(message: Column, patterns: tuple[str, ...]) -> Column:
    flat = F.trim(F.regexp_replace(message, r"\s+", " "))
    return F.coalesce(flat.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def is_rate_limited(m: Column) -> Column:
    return _says(m, RATE_LIMIT)


def is_skippable(m: Column) -> Column:
    return _says(m, SKIPPABLE)


def is_network_error(m: Column) -> Column:
    return _says(m, NETWORK)


def is_cookie_error(m: Column) -> Column:
    return _matches(m, COOKIE)


def is_auth_failure(m: Column) -> Column:
    return _matches(m, AUTH)


def retry_delay(attempt: Column, blocked: Column, cooldown: float = 900.0) -> Column:
    """Seconds before the next try."""
    wait = F.least(F.lit(cooldown), F.lit(max(60.0, cooldown / 4)) * attempt)
    return F.when(blocked, wait).otherwise(F.least(F.lit(30.0), 5.0 * attempt))


def timecode(c: Column) -> Column:
    """Seconds of MM:SS.mmm or HH:MM:SS.mmm; NULL for anything else."""
    p = F.split(c, ":")
    part = lambda i: F.expr("cast(null as double)") if i is None else p[i].try_cast("double")
    return F.when(F.size(p) == 2, part(0) * 60 + part(1)).when(F.size(p) == 3, part(0) * 3600 + part(1) * 60 + part(2))


def video_key(c: Column, host: str = "clips.example", short_host: str = "clip.example") -> Column:
    """The id in a video's address, or NULL: watch?v=, /shorts/ and /embed/ paths, and paths of the short host."""
    flat = F.trim(c)
    at = F.lower(F.regexp_extract(flat, r"^https?://([^/?#]+)", 1))
    path = F.regexp_extract(flat, r"^https?://[^/?#]+(/[^?#]*)", 1)
    query = F.regexp_extract(flat, r"[?&]v=([^&#\s]+)", 1)
    named = F.regexp_extract(path, r"^/(?:shorts|embed)/([^/]+)", 1)
    known = F.regexp_replace(at, r"^(?:www\.|m\.|music\.)", "") == host
    brief = F.regexp_extract(path, r"^/([^/]+)", 1)
    of_short = F.regexp_replace(at, r"^www\.", "") == short_host
    return F.when(known & (path == "/watch") & (query != ""), query).when(known & (named != ""), named).when(of_short & (brief != ""), brief)


def video_address(c: Column, host: str = "clips.example", short_host: str = "clip.example") -> Column:
    """The canonical address of a video, or NULL, from the forms that video_key() reads."""
    return F.concat(F.lit(f"https://{host}/watch?v="), video_key(c, host, short_host))


def video_of_audio(c: Column) -> Column:
    return F.regexp_replace(c, "^yt_", "")


def relative_wav(c: Column) -> Column:
    """A path with forward slashes, from its segments/ or data/processed/ part on."""
    flat = F.regexp_replace(c, r"\\", "/")
    cut = F.regexp_extract(flat, r"((?:data/processed|segments)/.*)$", 1)
    return F.when(cut != "", cut).otherwise(flat)


def percent(c: Column) -> Column:
    return F.when(c.isNull() | F.isnan(c), "—").otherwise(F.format_string("%.1f%%", c * 100))


def duration_text(c: Column) -> Column:
    """12.3s, or 2m05s from a minute on."""
    return F.when(c < 60, F.format_string("%.1fs", c)).otherwise(F.concat(F.floor(c / 60).cast("string"), F.lit("m"), F.lpad(F.floor(c % 60).cast("string"), 2, "0"), F.lit("s")))


def clock_text(c: Column) -> Column:
    """M:SS, or H:MM:SS from an hour on."""
    s = F.floor(c)
    mm, ss = F.floor(s % 3600 / 60), F.lpad((s % 60).cast("string"), 2, "0")
    return F.when(s < 3600, F.concat_ws(":", mm.cast("string"), ss)).otherwise(F.concat_ws(":", F.floor(s / 3600).cast("string"), F.lpad(mm.cast("string"), 2, "0"), ss))


def shortened(c: Column, most: int = 3800) -> Column:
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most - 3)), F.lit("..."))).otherwise(c)


def progress(step: Column, status: Column, finished: Column, total: Column) -> Column:
    """Percent done: finished addresses and the current one's steps, rounded half to even."""
    at = F.coalesce(F.array_position(F.array(*map(F.lit, STEPS)), step), F.lit(0))
    done = F.bround((finished + at / len(STEPS)) / F.greatest(total, F.lit(1)) * 100).cast("int")
    return F.when(status == "completed", 100).when((status == "queued") | step.isin("queued", "starting"), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(100), done)))


def scaled(c: Column, low: float, high: float) -> Column:
    """(c - low) / (high - low), within 0 and 1."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (c - low) / (high - low)))


def without_prefix(c: Column, prefix: Column) -> Column:
    """Text without a known prefix (compared without case and spacing, cut by its raw length); whole where nothing is left."""
    flat = lambda x: F.lower(F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    rest = F.trim(F.substr(c, F.length(prefix) + 1))
    return F.when(flat(c).startswith(flat(prefix)) & (rest != ""), rest).otherwise(c)


def match_score(haystack: Column, signals: Column) -> Column:
    """Sum over the signals that the text holds of 1 to 3 points by their words."""
    points = lambda s: F.least(F.lit(3), F.greatest(F.lit(1), F.size(F.split(s, " "))))
    return F.aggregate(F.filter(signals, lambda s: F.contains(haystack, s)), F.lit(0), lambda a, s: a + points(s))


def noise_floor(c: Column) -> Column:
    """The last "Noise floor dB" of a log, -Infinity included; NULL if there is none."""
    last = F.try_element_at(F.regexp_extract_all(c, F.lit(r"(?i)noise floor db:\s*(-?inf|-?[0-9.]+)"), 1), F.lit(-1))
    return F.regexp_replace(last, "(?i)inf", "Infinity").try_cast("double")


def stable_name(path: Column) -> Column:
    """A relative path as one file name: parts joined by __, other characters to _, and eight digits of its SHA-1."""
    stem = F.regexp_replace(F.regexp_replace(path, r"\.[^./]*$", ""), "/", "__")
    return F.concat_ws("__", F.regexp_replace(stem, r"[^\p{L}\p{N}._\-]", "_"), F.left(F.sha1(F.encode(path, "UTF-8")), F.lit(8)))


def seconds_between(started: Column, ended: Column) -> Column:
    """Seconds from one time to the other, two decimals, not below 0."""
    return F.greatest(F.lit(0.0), F.round(F.timestamp_diff("MILLISECOND", started, ended) / 1000, 2))
