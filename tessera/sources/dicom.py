"""DICOM Part 10 files, explicit VR little endian: a parser and writer of header attributes and pixels.

Files are read by Spark's binaryFile source; parsing runs in Arrow batches. Nested sequences give rows with the
path of tags above. What isn't a readable file of this kind gives an error and no attributes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values of the format
LONG_VR = frozenset("OB OD OF OL OV OW SQ UC UN UR UT".split())
EXPLICIT_LE = "1.2.840.10008.1.2.1"
KEYWORDS = {
    "PatientName": "00100010", "PatientID": "00100020", "PatientBirthDate": "00100030", "PatientSex": "00100040", "OtherPatientIDs": "00101000",
    "AccessionNumber": "00080050", "Modality": "00080060", "BodyPartExamined": "00180015", "ViewPosition": "00185101", "SeriesDescription": "0008103E",
    "Laterality": "00200060", "ImageComments": "00204000", "StudyDate": "00080020", "ContentDate": "00080023", "AcquisitionDate": "00080022",
    "SOPInstanceUID": "00080018", "StudyInstanceUID": "0020000D", "SeriesInstanceUID": "0020000E", "SOPClassUID": "00080016", "PrivateDate": "00331001",
    "Rows": "00280010", "Columns": "00280011", "BitsStored": "00280101", "PhotometricInterpretation": "00280004",
    "ReferringPhysicianName": "00080090", "PerformingPhysicianName": "00081050", "NameOfPhysiciansReadingStudy": "00081060", "PatientTelephoneNumbers": "00102154",
    "InstitutionName": "00080080", "InstitutionAddress": "00080081", "StationName": "00081010",
}
PIXELS = "7FE00010"
NUMBER = {"US": "<H", "SS": "<h", "UL": "<I", "SL": "<i", "FL": "<f", "FD": "<d"}
Element = tuple[str, str, object]  # tag, VR, value: text, number, bytes, or a list of lists of elements


class DicomError(ValueError):
    pass


def _value(vr: str, raw: bytes) -> object:
    if vr in NUMBER and len(raw) >= struct.calcsize(NUMBER[vr]):
        n = struct.calcsize(NUMBER[vr])
        got = [struct.unpack(NUMBER[vr], raw[i : i + n])[0] for i in range(0, len(raw) - n + 1, n)]
        return got[0] if len(got) == 1 else "\\".join(map(str, got))
    if vr in LONG_VR - {"UC", "UR", "UT"}:
        return raw
    return raw.decode("utf-8", "replace").rstrip("\0 ")


def parse(data: bytes, at: int = 0, end: int | None = None, depth: int = 0, pixels: bool = True) -> tuple[list[Element], int]:
    out: list[Element] = []
    end = len(data) if end is None else end
    if depth > 32:
        raise DicomError("sequences nest too deep")
    while at + 8 <= end:
        group, element = struct.unpack_from("<HH", data, at)
        tag = f"{group:04X}{element:04X}"
        if tag in ("FFFEE00D", "FFFEE0DD"):
            return out, at + 8
        vr = data[at + 4 : at + 6].decode("ascii", "replace")
        if not vr.isalpha() or not vr.isupper():
            raise DicomError(f"no VR at {at}")
        if vr in LONG_VR:
            (n,) = struct.unpack_from("<I", data, at + 8)
            at += 12
        else:
            (n,) = struct.unpack_from("<H", data, at + 6)
            at += 8
        if vr == "SQ":
            items, stop = [], end if n == 0xFFFFFFFF else at + n
            while at + 8 <= stop:
                mark, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
                at += 8
                if mark == b"\xfe\xff\xdd\xe0":
                    break
                item, at_item = parse(data, at, stop if size == 0xFFFFFFFF else at + size, depth + 1, pixels)
                items.append(item)
                at = at_item if size == 0xFFFFFFFF else at + size
            out.append((tag, vr, items))
            continue
        if n == 0xFFFFFFFF or at + n > end:
            raise DicomError(f"{tag} is longer than the file")
        if pixels or tag != PIXELS:
            out.append((tag, vr, _value(vr, data[at : at + n])))
        at += n
    return out, at


def read(data: bytes, pixels: bool = True) -> list[Element]:
    if len(data) < 132 or data[128:132] != b"DICM":
        raise DicomError("not a DICOM file")
    return parse(data, 132, pixels=pixels)[0]


def encode(elements: list[Element]) -> bytes:
    out = bytearray()
    for tag, vr, value in elements:
        if vr == "SQ":
            raw = b"".join(b"\xfe\xff\x00\xe0" + struct.pack("<I", len(x := encode(item))) + x for item in value)
        elif vr in NUMBER:
            raw = struct.pack(NUMBER[vr], value)
        else:
            raw = value if isinstance(value, bytes | bytearray) else str(value).encode()
            raw += (b"\0" if vr in ("UI", "OB", "UN") else b" ") * (len(raw) % 2)
        out += struct.pack("<HH", int(tag[:4], 16), int(tag[4:], 16)) + vr.encode()
        out += (b"\0\0" + struct.pack("<I", len(raw)) if vr in LONG_VR else struct.pack("<H", len(raw))) + raw
    return bytes(out)


def write(elements: list[Element]) -> bytes:
    meta = encode([("00020010", "UI", EXPLICIT_LE)])
    return bytes(128) + b"DICM" + encode([("00020000", "UL", len(meta))]) + meta + encode(sorted(elements, key=lambda e: e[0]))


def scan(spark: SparkSession, root: str, pattern: str = "*.dcm") -> DataFrame:
    """source_path, site_id, stem, sha256, size_bytes, content of every <root>/<site>/images/**/pattern."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    at = r"/([^/]+)/images/(?:.*/)?([^/]+)\.[^./]+$"
    rows = files.select(F.col("path").alias("source_path"), F.regexp_extract("path", at, 1).alias("site_id"), F.regexp_extract("path", at, 2).alias("stem"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"), "content")
    return rows.where("site_id != ''")


def attributes(objects: DataFrame, keep: tuple[str, ...] = ("source_path",)) -> DataFrame:
    """keep, path, tag, vr, value, error: a row an attribute at any depth; pixel data isn't read."""
    schema = T.StructType([objects.schema[k] for k in keep] + T.StructType.fromDDL("path array<string>, tag string, vr string, value string, error string").fields)

    def flat(elements: list[Element], path: list[str]) -> Iterator[tuple]:
        for tag, vr, v in elements:
            if vr == "SQ":
                yield path, tag, vr, None, None
                for item in v:
                    yield from flat(item, [*path, tag])
            else:
                yield path, tag, vr, v.hex() if isinstance(v, bytes) else str(v), None

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for r in part.itertuples(index=False):
                try:
                    got = list(flat(read(r[-1], pixels=False), []))
                except (DicomError, struct.error) as e:
                    got = [([], None, None, None, str(e))]
                rows += [(*r[:-1], *g) for g in got]
            yield pd.DataFrame(rows, columns=schema.names)

    return objects.select(*keep, "content").mapInPandas(run, schema)


def headers(objects: DataFrame, keep: tuple[str, ...] = ("source_path", "site_id"), keywords: dict[str, str] | None = None) -> DataFrame:
    """keep, a column a keyword (top level only), has_pixels, error."""
    wanted = keywords or KEYWORDS
    schema = T.StructType([objects.schema[k] for k in keep] + [T.StructField(k, T.StringType()) for k in wanted] + [T.StructField("has_pixels", T.BooleanType()), T.StructField("error", T.StringType())])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for r in part.itertuples(index=False):
                try:
                    got = {t: v for t, _, v in read(r[-1])}
                    rows.append((*r[:-1], *[None if t not in got else str(got[t]) for t in wanted.values()], PIXELS in got, None))
                except (DicomError, struct.error) as e:
                    rows.append((*r[:-1], *[None] * len(wanted), False, str(e)))
            yield pd.DataFrame(rows, columns=schema.names)

    return objects.select(*keep, "content").mapInPandas(run, schema)


def images(objects: DataFrame, keep: tuple[str, ...] = ("source_path",)) -> DataFrame:
    """keep, rows, columns, bits_stored, inverted, pixels of readable 16-bit images."""
    schema = T.StructType([objects.schema[k] for k in keep] + T.StructType.fromDDL("rows int, columns int, bits_stored int, inverted boolean, pixels binary").fields)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for r in part.itertuples(index=False):
                try:
                    e = {t: v for t, _, v in read(r[-1])}
                    h, w, px = int(e["00280010"]), int(e["00280011"]), e[PIXELS]
                    if len(px) >= 2 * h * w:
                        rows.append((*r[:-1], h, w, int(e.get("00280101", 16)), str(e.get("00280004", "")).strip().upper() == "MONOCHROME1", px[: 2 * h * w]))
                except (DicomError, struct.error, KeyError, ValueError):
                    continue
            yield pd.DataFrame(rows, columns=schema.names)

    return objects.select(*keep, "content").mapInPandas(run, schema)
