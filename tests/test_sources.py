import json
import struct
import zlib

from framewright.sources import readers, writers


def png(path, pixels):
    """A picture of RGB rows as a PNG file."""
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", len(pixels[0]), len(pixels), 8, 2, 0, 0, 0)
    body = b"".join(b"\0" + bytes(c for p in row for c in p) for row in pixels)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(body)) + part(b"IEND", b""))


def test_stills(spark, tmp_path):
    folder = tmp_path / "youtube" / "v1"
    folder.mkdir(parents=True)
    png(folder / "00000001.png", [[(1, 2, 3), (4, 5, 6)]])
    (folder / "00000002.png").write_text("not a picture")
    got = readers.read_stills(spark, str(tmp_path)).collect()
    assert [(r["source"], r["video_id"], r["width"], r["height"], bytes(r["data"])) for r in got] == [("youtube", "v1", 2, 1, bytes([3, 2, 1, 6, 5, 4]))]


def test_folders_metadata_and_logs(spark, tmp_path):
    for name, text in (("v1", '{"processed": true, "n": 3}'), ("v2", '{"broken'), ("v3", "x")):
        folder = tmp_path / "youtube" / name
        folder.mkdir(parents=True)
        (folder / "meta.json").write_text(text)
    (tmp_path / "youtube" / "v1" / "run.log").write_text("done\n")
    folders = readers.read_folders(spark, str(tmp_path))
    assert {tuple(r) for r in folders.collect()} == {("youtube", f"v{i}") for i in (1, 2, 3)}
    logs = {r["video_id"]: r["value"] for r in readers.read_logs(spark, str(tmp_path), folders).collect()}
    assert logs == {"v1": "done\n", "v2": readers.NO_LOG, "v3": readers.NO_LOG}
    meta = {r["video_id"]: (r["ok"], r["meta"]) for r in readers.read_metadata(spark, f"{tmp_path}/youtube/*/*.json").collect()}
    assert meta["v1"] == (True, {"processed": "true", "n": "3"})
    assert meta["v2"] == (False, {})


def test_split_files_and_registries(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"youtube": {"v1": "train", "v2": "test"}}, indent=2))
    assert sorted(map(tuple, readers.read_split_file(spark, str(path)).collect())) == [("youtube", "v1", "train"), ("youtube", "v2", "test")]
    path.write_text(json.dumps({"youtube": {"v1": {"title": "t"}}}, indent=1))
    assert [tuple(r) for r in readers.read_registry_json(spark, str(path)).collect()] == [("youtube", "v1", '{"title":"t"}')]


def test_bitmaps_of_any_width(spark, tmp_path):
    rows = [("s", f"v{w}", y, x, [(7 * x + y) % 256, 10 + y, 255 - x]) for w in (1, 2, 3, 4, 5) for y in range(3) for x in range(w)]
    frames = spark.createDataFrame(rows, "source string, video_id string, y int, x int, bgr array<int>").repartition(3)
    writers.write_stills(writers.bitmaps(frames, ["source", "video_id"]), str(tmp_path / "out"))
    got = {r["video_id"]: (r["width"], r["height"], bytes(r["data"])) for r in readers.read_stills(spark, str(tmp_path / "out")).collect()}
    for w in (1, 2, 3, 4, 5):
        assert got[f"v{w}"] == (w, 3, bytes(b for _, v, _, _, p in sorted(rows, key=lambda r: (r[2], r[3])) if v == f"v{w}" for b in p))
