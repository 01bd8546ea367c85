"""Fill-in-middle over seekable compressed frames.

``store_frames`` keeps a text as independent zstandard frames of at most ``FRAME_BYTES`` bytes of UTF-8, cut between
code points.  Each frame carries how many units end in it and how many code points and bytes it holds, so running sums
tell where any unit ends without reading the others.  A unit may run over several frames; it counts where it ends.

``fill_in_middle`` decompresses only the (at most two) frames that the cuts fall into.  The output is again a list of
independent frames: frames that no cut touches are passed on as they are, the parts of a cut frame are compressed anew,
and each mark is a frame of its own.  Joined, the frames are one valid zstandard stream.

``digests`` streams the output's frames in order; the text is rebuilt from output and form alone: one pass finds the
marks, a second one seeks the frames of prefix, middle and suffix.  At most one frame is open at a time.

Units are ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``: a unit ends behind every run without white
space, and at the end of a text that ends in white space.

Defined results: a null text is empty; an empty text and a text that holds a mark stay plain; a null id hashes as empty
text; repeated rows are treated alike, one by one; an empty table gives no rows; other columns are ignored.  Nothing is
shuffled, so neither skew nor ties matter.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acadlake.llm.common import id_text, small_batches, table
from acadlake.llm.words import utf8
from acadlake.session import cut_lineage

FRAME_BYTES = 1 << 16
LEVEL = 3
SEED = 42
FIM_PERCENT = 50            # texts that are cut
SPM_PERCENT = 80            # of these, suffix first
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
WHITE = b" \t\n\x0b\x0c\r"

FRAMES = "array<struct<units:bigint,chars:bigint,bytes:bigint,data:binary>>"


# ------------------------------------------------------------------------------------------ one text

def unit_ends(part: bytes, following: bytes):
    """Offsets behind the units that end in ``part``; ``following`` is the byte after it, empty at the text's end."""
    import numpy as np

    space = np.isin(np.frombuffer(part, np.uint8), np.frombuffer(WHITE, np.uint8))
    closed = not following or following in WHITE
    ends = np.flatnonzero(~space & np.append(space[1:], closed)) + 1
    return np.append(ends, len(part)) if not following and len(part) and space[-1] else ends


def code_points(part: bytes) -> int:
    import numpy as np

    return int(np.count_nonzero((np.frombuffer(part, np.uint8) & 0xC0) != 0x80))


def pack(text: bytes, size: int = FRAME_BYTES, level: int = LEVEL) -> list[tuple[int, int, int, bytes]]:
    """(units, chars, bytes, data) of each frame of a UTF-8 text."""
    from zstandard import ZstdCompressor

    squeeze, at, out = ZstdCompressor(level=level).compress, 0, []
    while at < len(text):
        end = min(len(text), at + size)
        while at + 1 < end < len(text) and text[end] & 0xC0 == 0x80:     # not inside a code point
            end -= 1
        part = text[at:end]
        out.append((len(unit_ends(part, text[end:end + 1])), code_points(part), len(part), squeeze(part)))
        at = end
    return out


def _open(data: bytes) -> bytes:
    from zstandard import ZstdDecompressor

    return ZstdDecompressor().decompress(data)


def place(frames: list[dict], unit: int, opened: dict[int, bytes]) -> tuple[int, int, int]:
    """(frame, byte in it, code points before) of the place behind ``unit`` units; opens only the frame it lies in."""
    units = chars = 0
    if not unit:
        return 0, 0, 0
    for i, f in enumerate(frames):
        if units + f["units"] >= unit:
            if i not in opened:
                opened[i] = _open(f["data"])
            part = opened[i]
            # whether a unit ends with the last byte is known from the count only
            ends = unit_ends(part, b"" if i == len(frames) - 1 else b"x")
            k = unit - units - 1
            at = int(ends[k]) if k < len(ends) else len(part)
            return i, at, chars + code_points(part[:at])
        units, chars = units + f["units"], chars + f["chars"]
    raise ValueError(f"{unit} units asked for, {units} stored")


def between(frames: list[dict], start: tuple, end: tuple, opened: dict[int, bytes], level: int = LEVEL) -> list[bytes]:
    """The frames from place ``start`` to place ``end``: whole ones as they are, parts of cut ones compressed anew."""
    from zstandard import ZstdCompressor

    out = []
    for i in range(start[0], min(end[0], len(frames) - 1) + 1):
        lo = start[1] if i == start[0] else 0
        hi = end[1] if i == end[0] else frames[i]["bytes"]
        if (lo, hi) == (0, frames[i]["bytes"]):
            out.append(frames[i]["data"])
        elif lo < hi:
            if i not in opened:
                opened[i] = _open(frames[i]["data"])
            out.append(ZstdCompressor(level=level).compress(opened[i][lo:hi]))
    return out


def assemble(frames: list[dict], first: int, second: int, form: str, marks: dict[str, bytes]) -> tuple:
    """(frames of the output, code points of the prefix, of the middle) of a text cut behind two unit counts."""
    opened: dict[int, bytes] = {}
    a, b = place(frames, first, opened), place(frames, second, opened)
    end = (len(frames), 0, None)
    parts = {"prefix": between(frames, (0, 0), a, opened), "middle": between(frames, a, b, opened),
             "suffix": between(frames, b, end, opened)}
    return [x for name in ORDERS[form] for x in (marks[name], *parts[name])], a[2], b[2] - a[2]


def stream(data: list[bytes], sizes: list[int], lo: int, hi: int) -> Iterator[bytes]:
    """Bytes ``lo`` to ``hi`` of the joined frames; frames outside stay closed."""
    at = 0
    for frame, n in zip(data, sizes):
        if at < hi and at + n > lo:
            yield _open(frame)[max(0, lo - at):hi - at]
        at += n


def read_output(data: list[bytes], form: str, take) -> tuple[list[int], list[tuple[int, int]]]:
    """Hands every byte of an output to ``take``, in order; the frames' sizes, the spans of prefix, middle and suffix."""
    sizes, total, tail, found = [], 0, b"", []
    wanted = [MARKS[name] for name in ORDERS.get(form, ())]
    for frame in data:
        part = _open(frame)
        take(part)
        sizes.append(len(part))
        seen, start = tail + part, total - len(tail)
        at = 0
        while len(found) < len(wanted) and (at := seen.find(wanted[len(found)], at)) >= 0:
            found.append(start + at)
            at += len(wanted[0])
        total += len(part)
        tail = seen[-(len(MARKS["prefix"]) - 1):] if len(found) < len(wanted) else b""
    if not wanted:
        return sizes, [(0, total)]
    if len(found) < len(wanted):
        raise ValueError(f"no {form} output: a mark is missing")
    ends = [*found[1:], total]
    at = {name: (s + len(MARKS[name]), e) for name, s, e in zip(ORDERS[form], found, ends)}
    return sizes, [at["prefix"], at["middle"], at["suffix"]]


def restored(data: list[bytes], form: str, take=lambda part: None) -> Iterator[bytes]:
    """The text that an output was made from, piece by piece."""
    sizes, spans = read_output(data, form, take)
    for lo, hi in spans:
        yield from stream(data, sizes, lo, hi)


# ------------------------------------------------------------------------------------------ tables

def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def store_frames(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = FRAME_BYTES) -> DataFrame:
    """(doc_id, n, marked, frames): unit count, whether the text holds a mark, and the frames in order; written."""
    small_batches(docs.sparkSession)
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        import pyarrow as pa

        frame = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("data", pa.binary())])
        names = [f.name for f in frame]
        for batch in batches:
            texts = [t or b"" for t in utf8(batch.column(1))]
            packed = [pack(t, size) for t in texts]
            columns = [batch.column(0), pa.array([sum(f[0] for f in p) for p in packed], pa.int64()),
                       pa.array([any(m in t for m in MARKS.values()) for t in texts], pa.bool_()),
                       pa.array([[dict(zip(names, f)) for f in p] for p in packed], pa.list_(frame))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "marked", "frames"])

    out = df.mapInArrow(run, f"doc_id {_kind(df, 'doc_id')}, n bigint, marked boolean, frames {FRAMES}")
    return cut_lineage(out, "fim-frames")


def fill_in_middle(store: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) with the output as frames."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), id_text(F.col("doc_id"))), 256)
    h = [F.conv(F.substring(key, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    cuts = [h[i] % (F.col("n") + 1) for i in range(2)]
    plain = (F.size("frames") == 0) | F.col("marked") | (h[2] % 100 >= fim_percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    df = store.select("doc_id", "n", form.alias("form"), F.least(*cuts).alias("first"),
                      F.greatest(*cuts).alias("second"), "frames")

    def run(batches):
        import pyarrow as pa

        marks = {name: pack(mark)[0][3] for name, mark in MARKS.items()}
        for batch in batches:
            made = [([f["data"] for f in frames], None, None) if form == "plain"
                    else assemble(frames, first, second, form, marks)
                    for form, first, second, frames in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
            columns = [*batch.columns[:3], pa.array([m[1] for m in made], pa.int64()),
                       pa.array([m[2] for m in made], pa.int64()),
                       pa.array([m[0] for m in made], pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return df.mapInArrow(run, f"doc_id {_kind(df, 'doc_id')}, n bigint, form string, prefix_chars bigint, "
                              "middle_chars bigint, output array<binary>")


def digests(outputs: DataFrame) -> DataFrame:
    """``outputs`` with output_sha256 and restored_sha256 in place of the output."""
    kept = [c for c in outputs.columns if c not in ("form", "output")]
    df = outputs.select(*kept, "form", "output")

    def run(batches):
        from hashlib import sha256

        import pyarrow as pa

        for batch in batches:
            out = [], []
            for form, data in zip(batch.column("form").to_pylist(), batch.column("output").to_pylist()):
                whole, again = sha256(), sha256()
                for part in restored(data, form, whole.update):
                    again.update(part)
                out[0].append(whole.hexdigest())
                out[1].append(again.hexdigest())
            columns = [*batch.columns[:-1], *(pa.array(x, pa.string()) for x in out)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "form", "output_sha256", "restored_sha256"])

    schema = ", ".join(f"`{c}` {_kind(df, c)}" for c in [*kept, "form"])
    return df.mapInArrow(run, f"{schema}, output_sha256 string, restored_sha256 string")


def output_texts(outputs: DataFrame) -> DataFrame:
    """(doc_id, form, text): the outputs as text."""
    df = outputs.select("doc_id", "form", "output")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [b"".join(map(_open, data)).decode() for data in batch.column("output").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())],
                                             ["doc_id", "form", "text"])

    return df.mapInArrow(run, f"doc_id {_kind(df, 'doc_id')}, form string, text string")


# ------------------------------------------------------------------------------------------ registered query

def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = digests(fill_in_middle(store_frames(table(spark, sf_dir, "documents"))))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


_H = ", ".join(f"cast('0x' || h[{8 * i + 1}:{8 * i + 8}] AS BIGINT) AS h{i + 1}" for i in range(4))
ORACLE = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(cast(doc_id AS VARCHAR), '')) AS h,
                  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
           FROM documents),
k AS (SELECT *, cast(len(u) AS BIGINT) AS n, {_H} FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                       OR h3 % 100 >= {FIM_PERCENT} THEN 'plain'
                  WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
             coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN cast(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN cast(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
