"""End-to-end jobs on generated fixtures."""

import glob
import gzip
import os
import tarfile

from capset import jobs as J
from fixtures import pair_tree, png_bytes, records, write


def _members(folder):
    out = {}
    for f in sorted(glob.glob(os.path.join(folder, "*.tar*"))):
        with tarfile.open(f) as t:
            for m in t.getmembers():
                out[m.name] = t.extractfile(m).read()
    return out


def test_shards_from_folder(spark, tmp_dir):
    data = pair_tree(os.path.join(tmp_dir, "data"))
    rep = J.shards_from_folder(spark, data, os.path.join(tmp_dir, "shards"), maxcount=2, json=True).first()
    assert (rep.texts, rep.images, rep.pairs, rep.invalid_images, rep.written) == (6, 6, 5, 2, 3)
    m = _members(os.path.join(tmp_dir, "shards"))
    assert sorted(k for k in m if k.endswith(".img")) == ["000000000.img", "000000001.img", "000000002.img"]
    assert m["000000000.cap"] == b"a small red square"
    assert m["000000000.json"] == b'{"a":[1,2],"b":1}'
    assert m["000000002.img"] == png_bytes(3, 3)  # w00001/000000000.png, third pair in (folder, stem) order


def test_shards_from_tfrecords(spark, tmp_dir):
    exs = []
    for i in range(12):
        img = b"same" if i in (3, 7) else bytes([i]) * 10
        w, h = [(100, 100), (400, 200), (250, 250)][i % 3]
        exs.append({"sampleID": f"s{i}".encode(), "image": img, "format": b"jpeg", "label": f"l{i}".encode(),
                    "height": h, "width": w})
    os.makedirs(f"{tmp_dir}/tfr")
    for name, part in (("a.tfrecord", exs[:6]), ("b.tfrecord", exs[6:])):
        records(f"{tmp_dir}/tfr/{name}", part)
    rep = J.shards_from_tfrecords(spark, f"{tmp_dir}/tfr", f"{tmp_dir}/shards", use_encoder=True).first()
    # duplicates: record 7 repeats record 3; sizes: i%3==0 -> discard (both < 192), 1 -> resize, 2 -> keep
    assert (rep.total, rep.duplicates, rep.discarded, rep.to_resize) == (12, 1, 4, 3)  # 7 is a copy
    assert rep.remaining == 7
    m = _members(f"{tmp_dir}/shards")
    keys = sorted({k.split(".")[0] for k in m})
    assert keys == ["%09d" % i for i in (1, 2, 4, 5, 8, 10, 11)]  # gaps stay
    assert m["000000004.label.cls"] == b"l4" and "000000004.image.pyd" in m
    assert {k for k in m if k.endswith("resize_to")} == {"000000001.resize_to", "000000004.resize_to", "000000010.resize_to"}
    assert m["000000001.resize_to"] == b"640x320"
    assert sorted(os.path.basename(f) for f in glob.glob(f"{tmp_dir}/shards/*.tar")) == ["wds_000000.tar"]
    # all fields of an inferred schema, none left out
    rep = J.shards_from_tfrecords(spark, f"{tmp_dir}/tfr", f"{tmp_dir}/all", features=None, keep_keys="",
                                  remove_duplicates="", min_max_size="").first()
    m = _members(f"{tmp_dir}/all")
    assert rep.remaining == 12 and len(m) == 12 * 6
    assert (m["000000005.height"], m["000000005.label"], m["000000007.image"]) == (b"250", b"l5", b"same")


def test_captions_from_manifest(spark, tmp_dir):
    from capset.sources.manifests import WIDE_MANIFEST_DDL

    names = [c.split()[0] for c in WIDE_MANIFEST_DDL.split(", ")]

    def row(lang, url, ref, attr, alt):
        r = dict.fromkeys(names, "")
        r.update(language=lang, image_url=url, caption_reference_description=ref,
                 caption_attribution_description=attr, caption_alt_text_description=alt,
                 original_height="10", original_width="10", is_main_image="true", attribution_passes_lang_id="true")
        return "\t".join(r[n] for n in names)

    lines = ["\t".join(names),
             row("en", "http://x/a.jpg", "A  cat &amp; dog..", "", ""),
             row("de", "http://x/b.jpg", "Hund", "", ""),
             row("en", "http://x/c.SVG", "", "English: a map\nDeutsch: eine Karte", "")]
    os.makedirs(f"{tmp_dir}/m")
    with gzip.open(f"{tmp_dir}/m/part-00000-of-00001.tsv.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    res = {r.key: r for r in J.captions_from_manifest(spark, f"{tmp_dir}/m", out=f"{tmp_dir}/out").collect()}
    assert res["000000000"].caption == "A cat and dog."
    assert res["000000002"].caption == "a map" and res["000000002"].media_kind == "svg"
    assert "000000001" not in res
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 2


def test_captions_from_labels(spark, tmp_dir):
    write(f"{tmp_dir}/dict.csv", "/m/a,Cat\n/m/b,Dog\n")
    write(f"{tmp_dir}/val.csv", "ImageID,LabelName,Confidence\ni1,/m/a,1\ni1,/m/b,0\ni2,/m/b,0\n")
    write(f"{tmp_dir}/train.csv", "ImageID,LabelName,Confidence\ni1,/m/b,1\ni3,/m/a,1\n")
    write(f"{tmp_dir}/n.jsonl", '{"image_id": "i3", "caption": "a narrative"}\n')
    res = {r.image_id: r for r in J.captions_from_labels(
        spark, {"validation": f"{tmp_dir}/val.csv", "train": f"{tmp_dir}/train.csv"}, f"{tmp_dir}/dict.csv",
        ["shows {certain}"], [", or {maybe}"], narratives=[f"{tmp_dir}/n.jsonl"], out=f"{tmp_dir}/caps").collect()}
    assert sorted(res) == ["i1", "i2", "i3"]
    assert res["i1"].path.endswith("train-256/i1.jpg") and "dog" in res["i1"].caption  # train wins over val
    assert res["i2"].dropped and res["i3"].caption == "a narrative"


def test_vocabulary_and_check(spark, tmp_dir):
    data = pair_tree(os.path.join(tmp_dir, "data"))
    J.shards_from_folder(spark, data, os.path.join(tmp_dir, "shards"))
    vocab, merges = J.vocabulary_from_shards(spark, os.path.join(tmp_dir, "shards"), text_key="cap",
                                             coverage=1.0, vocab_size=30)
    n_chars = vocab.count() - merges.count()
    assert vocab.count() == 30 or merges.count() < 30 - n_chars  # vocabulary size reached unless pairs ran out
    v2, m2 = J.vocabulary_from_shards(spark, data, coverage=1.0, vocab_size=25)
    assert v2.count() <= 25
    rep = {r.folder: r for r in J.check_folder(spark, data).collect()}
    assert rep["w00000"].incomplete == ["000000002.txt", "000000003.png"]


def test_rerun_of_resume_job_does_nothing(spark, tmp_dir):
    from capset import sinks as K
    from capset.operators import resume as RS
    from capset.sources.manifests import WIDE_MANIFEST_DDL

    names = [c.split()[0] for c in WIDE_MANIFEST_DDL.split(", ")]
    lines = ["\t".join(names)]
    for i in range(20):
        r = dict.fromkeys(names, "")
        r.update(language="en", image_url=f"http://x/{i}.jpg", caption_reference_description=f"caption {i}",
                 original_height="1", original_width="1")
        lines.append("\t".join(r[n] for n in names))
    os.makedirs(f"{tmp_dir}/m")
    with gzip.open(f"{tmp_dir}/m/a.tsv.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    ledger = f"{tmp_dir}/ledger"
    K.append_ledger(RS.ledger_from(spark.range(0, 5).withColumnRenamed("id", "row_id"), "fetch", "done"), ledger)
    first = J.captions_from_manifest(spark, f"{tmp_dir}/m", ledger=ledger)
    assert first.count() == 15
    K.append_ledger(RS.ledger_from(first.select("row_id"), "fetch", "done"), ledger)
    assert J.captions_from_manifest(spark, f"{tmp_dir}/m", ledger=ledger).count() == 0


def test_done_in_folder_and_scoring(spark, tmp_dir):
    write(f"{tmp_dir}/out/00000/000000001.txt", "x")
    write(f"{tmp_dir}/out/00000/000000001.jpg", b"x")
    write(f"{tmp_dir}/out/00000/000000002.txt", "only text")
    assert [r.row_id for r in J.done_in_folder(spark, f"{tmp_dir}/out").collect()] == [1]
    imgs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "row_id long, embedding array<float>")
    caps = spark.createDataFrame([(1, "section_title", [1.0, 0.0]), (1, "context_page_description", [0.0, 1.0]),
                                  (2, "section_title", [0.6, 0.8])], "row_id long, field string, embedding array<float>")
    wide, best = J.score_candidates(spark, imgs, caps, out=f"{tmp_dir}/sim", save_embeddings=f"{tmp_dir}/emb")
    w = {r.row_id: r for r in wide.collect()}
    assert w[1].section_title == 1.0 and w[1].context_page_description == 0.0 and w[2].section_title == 0.8
    b = {r.row_id: (r.best_field, r.above) for r in best.collect()}
    assert b == {1: ("section_title", True), 2: ("section_title", True)}
    assert spark.read.parquet(f"{tmp_dir}/emb").count() == 2


def test_last_narrative_in_the_order_of_the_files_wins(spark, tmp_dir):
    write(f"{tmp_dir}/dict.csv", "/m/a,Cat\n")
    write(f"{tmp_dir}/val.csv", "ImageID,LabelName,Confidence\ni1,/m/a,1\ni2,/m/a,1\n")
    # the first file is larger: Spark would read it later
    write(f"{tmp_dir}/1.jsonl", '{"image_id": "i1", "caption": "one"}\n' * 500)
    write(f"{tmp_dir}/2.jsonl", '{"image_id": "i1", "caption": "two"}\n{"image_id": "i1", "caption": "last"}\n')
    write(f"{tmp_dir}/root/images/256px/validation/i1.jpg", b"x")
    for files, want in (("12", "last"), ("21", "one")):
        res = {r.image_id: r for r in J.captions_from_labels(
            spark, {"validation": f"{tmp_dir}/val.csv"}, f"{tmp_dir}/dict.csv", ["{certain}"], ["{maybe}"],
            narratives=[f"{tmp_dir}/{n}.jsonl" for n in files], images=f"{tmp_dir}/root").collect()}
        assert res["i1"].caption == want
        assert not res["i1"].dropped and res["i2"].dropped  # no file


def test_names_with_blanks_hashes_and_other_letters(spark, tmp_dir):
    data = os.path.join(tmp_dir, "a dir", "tree")
    stems = ["pic#4", "pic#5", "a b", "50%", "ä+1", "x?y", "plain"]
    for s in stems:
        write(f"{data}/über 1/{s}.png", png_bytes(4, 3))
        write(f"{data}/über 1/{s}.txt", f"text of {s}")
    rep = J.check_folder(spark, data).collect()
    assert all(not (r.incomplete or r.corrupt or r.empty or r.delete) for r in rep)
    out = J.shards_from_folder(spark, data, os.path.join(tmp_dir, "shards"), maxcount=3).first()
    assert (out.pairs, out.invalid_images, out.written) == (7, 0, 7)
    m = _members(os.path.join(tmp_dir, "shards"))
    assert sorted(v.decode() for k, v in m.items() if k.endswith(".cap")) == sorted(f"text of {s}" for s in stems)
    assert sorted(os.path.basename(f) for f in glob.glob(f"{tmp_dir}/shards/*.tar")) == [f"ds_{i:06d}.tar" for i in range(3)]


def test_relative_roots_list_what_absolute_ones_do(spark, tmp_dir):
    from capset.sources.files import scan_files

    pair_tree(os.path.join(tmp_dir, "tree"))
    # the folder that the session started in is what relative paths are relative to
    started = spark.sparkContext._jvm.java.io.File(".").getCanonicalPath()
    root = os.path.relpath(os.path.join(tmp_dir, "tree"), started)
    listed = [sorted(r.rel for r in scan_files(spark, r, depth=1).collect()) for r in (root, os.path.join(tmp_dir, "tree"))]
    assert listed[0] == listed[1] and len(listed[0]) == 14
