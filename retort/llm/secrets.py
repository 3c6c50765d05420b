"""Secrets in texts: known forms, and strings in a sensitive context that zstandard can't compress from what is around them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retort.llm.common import carried, read, released

# The forms of known secrets, in the order in which their kinds are listed, and the least length of each.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
FORMS = (("assign", ASSIGN, 2, 12), ("access", ACCESS, 0, 18), ("hex", HEX, 0, 16))
KINDS = ("assign", "access", "hex", "novel")

#: A candidate: a long run of what keys are written in, so long that its compressed size tells something.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]{20,}")
#: What makes a context sensitive, and how far before a candidate it may stand, in code points.
SENSITIVE = re.compile(r"api|auth|bearer|cert|credential|cookie|hmac|key|login|passphrase|passwd|password|private|pwd|secret|session|signature|token", re.IGNORECASE | re.ASCII)
NEAR = 48
#: Code points on either side of a candidate that are its surrounding code.
AROUND = 512
#: A candidate is novel if it adds at least so many compressed bytes for each of its own. Random strings add all of theirs.
NOVELTY = 0.85
#: Identifiers and words of code, which say nothing new.
IDENTIFIERS = (
    "access account address algorithm api application argument array assert async attribute authorization await base64 boolean branch"
    " buffer build bytes cache callback certificate channel character class client close cluster column command commit config connection const"
    " container content context continue controller cookie create credential cursor data database datetime decode default define delete"
    " description directory document domain element enable encode encrypt endpoint environment error event example exception execute export"
    " extends external false field filename filter finally format function generate github global handler hash header http https"
    " identifier image import include index input integer interface internal iterator json keyword lambda language"
    " length library list localhost login manager message metadata model module namespace network number object operator"
    " option origin output override package parameter parent parse password path pattern payload permission port primary private"
    " property protocol provider public python query random read receive reference register remote remove replace"
    " repository request require resource response result return runtime schema search secret select sequence serialize server"
    " service session settings shared signature socket source static storage stream string success system table target"
    " template test text thread timeout timestamp token transaction true type update upload username utf-8 validate value variable"
    " version view website width write www"
)
#: Runs that only look like keys.
_RUN = re.compile(r"0123456789|abcdefghijklmnopqrstuvwxyz|ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def known(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the known forms: of each kind all leftmost matches that don't overlap, but those too short."""
    found = []
    for at, (_, pattern, group, least) in enumerate(FORMS):
        found += [(m.start(), at, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return [(start, end, KINDS[at]) for start, at, end in sorted(found)]


class Novelty:
    """Marginal compressed bytes of strings, against identifiers and what surrounds each."""

    def __init__(self, identifiers: str = IDENTIFIERS, level: int = 19) -> None:
        self.identifiers, self.level = identifiers.encode(), level
        self.empty = self.size(b"", self.identifiers)

    def size(self, data: bytes, dictionary: bytes) -> int:
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=self.level, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False).compress(data))

    def ratio(self, candidate: str, around: str) -> float:
        """Compressed bytes that a candidate adds to its dictionary for each byte of its own."""
        data = candidate.encode("utf-8", "replace")
        return (self.size(data, self.identifiers + b"\n" + around.encode("utf-8", "replace")) - self.empty) / max(1, len(data))


def varied(candidate: str) -> bool:
    """Whether a candidate is written as keys are: digits and letters change often, and no path, version or number does so."""
    digits = sum(c.isdigit() for c in candidate)
    letters = sum(c.isalpha() for c in candidate)
    return digits >= 2 and letters >= 4 and len(set(candidate)) >= 8 and not _RUN.search(candidate)


def novel(text: str, novelty: Novelty, least: float = NOVELTY) -> list[tuple[int, int, str]]:
    """(start, end, `novel`) of the candidates in a sensitive context that their dictionaries don't explain."""
    found = []
    if not SENSITIVE.search(text):
        return found
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        if varied(m.group()) and SENSITIVE.search(text, max(0, start - NEAR), start):
            around = text[max(0, start - AROUND) : start] + "\n" + text[end : end + AROUND]
            if novelty.ratio(m.group(), around) >= least:
                found.append((start, end, "novel"))
    return found


def secrets_of(text: str | None, novelty: Novelty | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret of a text, by start and then as the kinds are listed; code points, end exclusive.

    A novel string that overlaps a known form says nothing more and isn't given again.
    """
    if not text:
        return []
    found = known(text)
    added = [s for s in novel(text, novelty or Novelty()) if all(s[1] <= start or end <= s[0] for start, end, _ in found)]
    return sorted(found + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The kept columns and spans array<struct<start, end, kind>> of every row of docs.

    Known forms are assignments to names of secrets, access key ids and long hexadecimal runs. Further spans, `novel`,
    are strings near a word that tells of secrets which zstandard, primed with common identifiers and the text around
    them, can hardly compress. Null and empty texts have none, very long ones are searched whole, in time linear in
    their length; repeated rows give repeated results, an empty table an empty one; other columns are ignored.
    """
    rows, name, kept, schema = carried(docs, keep, text, "spans array<struct<start: long, end: long, kind: string>>")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in released(batches):
            spans = [[{"start": a, "end": z, "kind": k} for a, z, k in secrets_of(t, novelty)] for t in batch.column(name).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(spans, kind)], names=[*kept, "spans"])

    return rows.mapInArrow(run, schema)


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents", "doc_id", "text"), "doc_id")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
