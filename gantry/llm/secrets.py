"""Secret scan: fixed patterns, and strings that a tokenizer finds hard to compress.

Natural words are few tokens of a public vocabulary; random strings are many. A run
of 20 or more key characters with a low ratio of characters to tokens is reported,
unless it has the form of a known digest or identifier. Of a run that as a whole has a
high ratio, such as a path with a key at its end, every stretch between ``/ _ - = +`` is
judged, and those of low ratio are reported; digests, identifiers and numbers in the run
end a stretch.

Cases: a null text is an empty one and has no spans; equal rows give equal results;
an empty table gives an empty table; other columns are left out of the result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import text_or_empty

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_CHARS_PER_TOKEN = 2.0
MIN_LENGTH = 20

# ---- fixed values of the contract ----
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# --------------------------------------

_KEY_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+").pattern

# Strings that look random but are no secrets: digests by their length in hex,
# integrity hashes, UUIDs, plain numbers and dates.
_KNOWN = re.compile(
    r"""(?:sha(?:1|256|384|512)[-=:/])?(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}
        |[0-9a-fA-F]{96}|[0-9a-fA-F]{128})
    |sha(?:256|384|512)-[A-Za-z0-9+/]+=*
    |(?:urn[-=/])?(?:uuid[-=/])?[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}
    |[0-9+/_=-]+""",
    re.VERBOSE,
)

#: The same within a run.
_KNOWN_PART = re.compile(
    r"""(?<![A-Za-z0-9])(?:
        sha(?:256|384|512)-[A-Za-z0-9+/]{40,}=*
        |[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}
        |[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}
        |[0-9]{2,}
    )(?![A-Za-z0-9])""",
    re.VERBOSE,
)
_PIECE = re.compile(r"[A-Za-z0-9]+|[/_=+-]")

Span = tuple[int, str, int]


def encoder(path: str):
    """The vocabulary at ``path`` (ranks in tiktoken's text form), loaded once per process."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        _encoders[path] = tiktoken.Encoding("public", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


_encoders: dict = {}


def pattern_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and non-overlapping for each kind."""
    found: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in _KEY_WORDS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    # a greedy run of hex digits is cut nowhere else, so asking for 24 at once is the same
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return found


def costly_stretches(run: str, encode, max_chars_per_token: float) -> list[tuple[int, int]]:
    """Where a run has stretches of whole pieces that are costly in tokens; they do not overlap."""
    found: list[tuple[int, int]] = []
    begin = 0
    for known in [*_KNOWN_PART.finditer(run), None]:
        end = known.start() if known else len(run)
        if end - begin >= MIN_LENGTH:
            pieces = [(m.start(), m.end()) for m in _PIECE.finditer(run, begin, end)]
            found += _costly(run, pieces, encode, max_chars_per_token)
        begin = known.end() if known else end
    return found


def _costly(run: str, pieces: list[tuple[int, int]], encode, max_chars_per_token: float) -> list[tuple[int, int]]:
    # a stretch has at most so many characters a token if its gains add up to 0 or more; what
    # stands between words is a token of its own in any text, so it counts for neither side
    gains = [max_chars_per_token * len(encode(run[a:b])) - (b - a) if run[a].isalnum() else 0.0 for a, b in pieces]
    totals = [0.0]
    for gain in gains:
        totals.append(totals[-1] + gain)
    found: list[tuple[int, int]] = []
    waiting = [(0, len(pieces))]
    while waiting:
        low, high = waiting.pop()
        # the stretch of the highest gain among those long enough: its best begin for each end
        best, lowest, first = None, None, low
        for last in range(low, high):
            while first <= last and pieces[last][1] - pieces[first][0] >= MIN_LENGTH:
                if run[pieces[first][0]].isalnum() and (lowest is None or totals[first] < totals[lowest]):
                    lowest = first
                first += 1
            if lowest is not None and run[pieces[last][0]] not in "/_-+":
                gain = totals[last + 1] - totals[lowest]
                if gain >= 0 and (best is None or gain > best[0]):
                    best = (gain, lowest, last + 1)
        if best:
            _, a, b = best
            stretch = run[pieces[a][0] : pieces[b - 1][1]]
            if any(c.isalpha() for c in stretch):
                found.append((pieces[a][0], pieces[b - 1][1]))
            waiting += [(low, a), (b, high)]
    return sorted(found)


def _merged(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Begins and ends of the ranges that spans sorted by start cover together."""
    begins: list[int] = []
    ends: list[int] = []
    for start, _, end in spans:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            begins.append(start)
            ends.append(end)
    return begins, ends


def random_spans(text: str, encode, max_chars_per_token: float, taken: list[Span]) -> list[Span]:
    """Runs, or stretches of them, that are costly in tokens, outside the spans already found."""
    found: list[Span] = []
    begins, ends = _merged(taken)
    for m in _RUN.finditer(text):
        run = m[0]
        if not any(c.isalpha() for c in run) or _KNOWN.fullmatch(run):
            continue
        if len(run) / len(encode(run)) <= max_chars_per_token:
            parts = [(0, len(run))]
        else:
            parts = costly_stretches(run, encode, max_chars_per_token)
        for a, b in parts:
            a, b = m.start() + a, m.start() + b
            before = bisect_left(begins, b) - 1  # the last one that begins before this ends
            if before < 0 or ends[before] <= a:
                found.append((a, "random", b))
    return found


def scan(text: str, encode, max_chars_per_token: float) -> tuple[list[Span], list[Span]]:
    """Spans of the fixed patterns, and all spans, each by start and then kind."""
    order = lambda span: (span[0], KINDS.index(span[1]))
    # nothing can match in a text whose words are all shorter than the shortest key
    long_word = max(map(len, text.split()), default=0) >= MIN_LENGTH
    base = sorted(pattern_spans(text) if long_word else _short(text), key=order)
    more = random_spans(text, encode, max_chars_per_token, base) if long_word else []
    return base, sorted(base + more, key=order)


def _short(text: str) -> list[Span]:
    lower = text.lower()
    if not any(word in lower for word in _KEY_WORDS):
        return []
    return [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


_RESULT = """n_assign long, n_access long, n_hex long, base_sha256 string, spans string,
             n_random long, redacted string"""


def secret_report(text: Column, vocabulary: str, max_chars_per_token: float, redact: bool) -> Column:
    """A struct of counts, span lists and, if ``redact``, the text with the spans replaced."""

    @F.pandas_udf(_RESULT)
    def report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary).encode_ordinary
        for texts in batches:
            rows = []
            for text in texts:
                base, spans = scan(text, encode, max_chars_per_token)
                count = lambda kind, spans=spans: sum(span[1] == kind for span in spans)
                listed = joined(base)
                rows.append(
                    (
                        count("assign"),
                        count("access"),
                        count("hex"),
                        hashlib.sha256(listed.encode()).hexdigest(),
                        joined(spans),
                        count("random"),
                        masked(text, spans) if redact and spans else None,
                    )
                )
            yield pd.DataFrame(
                rows,
                columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random", "redacted"],
            )

    return report(text)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by a mark."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    max_chars_per_token: float = MAX_CHARS_PER_TOKEN,
) -> DataFrame:
    """One row per document: counts by kind, the digest of the pattern spans, and all spans."""
    found = docs.select(
        F.col(id_col),
        secret_report(text_or_empty(text_col), vocabulary, max_chars_per_token, redact=False).alias("found"),
    )
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
    return found.select(id_col, *[F.col(f"found.{name}").alias(name) for name in names])


def redact_secrets(
    docs: DataFrame,
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    max_chars_per_token: float = MAX_CHARS_PER_TOKEN,
) -> DataFrame:
    """The same rows and columns; in each text every secret is replaced by the mark of its kind.

    A text without secrets, null included, stays as it is.
    """
    report = secret_report(text_or_empty(text_col), vocabulary, max_chars_per_token, redact=True)
    clean = F.coalesce(report.getField("redacted"), F.col(text_col))
    return docs.withColumn(text_col, clean)
