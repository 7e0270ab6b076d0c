"""Local files: the whole-file reader and the splittable one against plain Python."""

import json
import re

import pytest
from almanac.sources import text_files

KEYS = ["text", "content", "body", "abstract", "title", "summary", "passage", "document"]


def of_json(obj):
    if isinstance(obj, str):
        return obj.strip() or None
    if not isinstance(obj, dict):
        return None
    for k in KEYS:
        if isinstance(obj.get(k), str) and obj[k].strip():
            return obj[k].strip()
    p, c = obj.get("prompt"), obj.get("completion")
    return (f"{p.strip()}\n{c.strip()}".strip() or None) if isinstance(p, str) and isinstance(c, str) else None


def plain(path, most):
    raw = path.read_text(errors="ignore")
    name = path.name.lower()
    if not name.endswith((".json", ".jsonl")):
        return [c.strip() for c in re.split(r"\n\s*\n+", raw) if len(c.strip()) >= most]
    raw, docs = raw.strip(), []
    if "\n" in raw or name.endswith(".jsonl"):
        for line in filter(None, map(str.strip, raw.splitlines())):
            try:
                text = of_json(json.loads(line))
            except ValueError:
                text = line
            if text and len(text) >= most:
                docs.append(text)
    if not docs:
        try:
            value = json.loads(raw)
        except ValueError:
            return []
        docs = [t for t in map(of_json, value if isinstance(value, list) else [value]) if t and len(t) >= most]
    return docs


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    f = tmp_path_factory.mktemp("files")
    (f / "deep" / "er").mkdir(parents=True)
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(k % 90))
    (f / "A.TXT").write_text("first paragraph\n\n\n second  one\nwith two lines\n \t\n" + "\n\n".join(words(k) + ("\n" + words(k + 3) if k % 2 else "") for k in range(200)) + "\n\n\n")
    (f / "deep" / "b.Md").write_text("no blank line " * 400)
    (f / "deep" / "c.md").write_text("")
    (f / "deep" / "skip.html").write_text("not a text file")
    lines = [json.dumps({KEYS[k % 8]: words(k), "n": k}) if k % 5 else "broken { line " + words(k) for k in range(300)]
    (f / "deep" / "er" / "d.JSONL").write_text("\r\n".join(lines) + "\n\n" + json.dumps({"text": 5, "body": "x" * 40}) + "\n" + json.dumps({"prompt": "p" * 30, "completion": "c"}))
    (f / "e.json").write_text("\n".join(lines[:50]))
    (f / "f.json").write_text(json.dumps([{"text": words(k)} for k in range(80)] + ["a plain string of some length", 7, ["list"]]))
    (f / "g.json").write_text("{\n\"text\":\n\"pretty\"\n}")  # no line is long enough: one value
    (f / "h.json").write_text("[\n" + ",\n".join(json.dumps({"text": words(k)}) for k in range(40, 60)) + "\n]")  # lines first: raw lines with their commas
    (f / "i.json").write_text("one line that is not json and long enough")
    (f / "j.json").write_text(json.dumps({"text": "an object in one line, long enough"}))
    (f / "k.jsonl").write_text("[\"an array in a lines file\", {\"text\": \"has no line with a text\"}]")
    (f / "l.json").write_text(json.dumps({"text": "a" * 20}) + "\r" + json.dumps({"text": "b" * 20}))
    (f / "n.txt").write_bytes(b"\r\n \r\n".join(words(k).encode() + b"\r\nsecond line" for k in range(60)) + b"\n\nand a line feed alone")
    (f / "m.txt").write_bytes(b"bytes that are \xff\xfe not all text\n\nbut the rest \xc3\xa9 is")
    return f


def expected(folder, most):
    return sorted((p.name, t) for p in folder.rglob("*") if p.is_file() and p.suffix.lower() in (".txt", ".md", ".json", ".jsonl") for t in plain(p, most))


@pytest.mark.parametrize("most", [6, 20])
def test_both_readers_equal_plain_python(spark, folder, most):
    name = lambda r: (r.path.rsplit("/", 1)[1], r.text)
    assert sorted(map(name, text_files.local_documents(spark, str(folder), most).collect())) == expected(folder, most)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = text_files.split_documents(spark, str(folder), most)
        assert rows.rdd.getNumPartitions() > 20
        got = rows.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(name, got)) == expected(folder, most)
    for p in ("A.TXT", "d.JSONL", "h.json", "n.txt"):  # in the file's order
        mine = sorted((r for r in got if r.path.endswith(p)), key=lambda r: (r.block, r.at, r.part))
        assert [r.text for r in mine] == plain(next(folder.rglob(p)), most)


def test_single_files_and_folders_without_texts(spark, folder, tmp_path):
    (tmp_path / "x.log").write_text("a log is read as text if it is named itself")
    for read in (text_files.local_documents, text_files.split_documents):
        assert [r.text for r in read(spark, str(tmp_path / "x.log")).collect()] == ["a log is read as text if it is named itself"]
        assert len(read(spark, str(folder / "e.json"), 6).collect()) == len(plain(folder / "e.json", 6))
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path))
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path / "none"))


def test_lines_of_json_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "one"}\n{"body": "two ]"}\nno json\n{"text": "x"}], [{"y": 1}\n')
    (tmp_path / "b.json").write_text('{"text": "three"}\n{"text": "four"}\n')
    found = text_files.split_documents(spark, str(tmp_path))
    assert sorted(r.text for r in found.collect()) == ["four", "no json", "one", "three", "two ]", '{"text": "x"}], [{"y": 1}']
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("parseJson") <= 4  # filters on the text don't parse a line again, nor does a second look that no file needs
