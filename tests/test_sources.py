"""Parsers and sinks on inline files, and streams against their batch forms."""

import io
import json
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from cantilena.sources import captions, feeds, files, protocols, sinks
from cantilena.streaming import words as stream

VTT = "﻿WEBVTT\n\nNOTE a remark\n\n1\n00:00:01.500 --> 00:00:03.000\nfirst (line)\nand: second\n\n00:05.000 --> 00:06.000\nno hours\n\n0:00:07.000-->0:00:08.250\nשָׁלוֹם\nWEBVTT too\n"
SUBTITLES = "head\n01:00:00:00 01:00:01:00\nnot yet\n<begin subtitles>\n01:00:01:00 01:00:02:12\none line\n\n01:00:03:00 01:00:04:24\ntwo\nlines\n<end subtitles>\n"


def test_vtt(spark):
    df = spark.createDataFrame([("p", VTT)], "path string, content string")
    got = [tuple(r) for r in captions.vtt_segments(df).orderBy("id").collect()]
    assert got == [("p", 0, 1.5, 3.0, " first line and second"), ("p", 1, 7.0, 8.25, " שלום WEBVTT too")]
    index = [tuple(r) for r in captions.vtt_time_index(captions.vtt_segments(df)).orderBy("id").select("start_loc", "end_loc", "timestamp").collect()]
    assert index == [(0, 22, 1.0), (22, 38, 7.0)]


def test_subtitles(spark):
    got = captions.subtitle_rows(spark.createDataFrame([("p", SUBTITLES)], "path string, content string"))
    assert [(round(r["start_time"], 2), round(r["end_time"], 2), r["text"]) for r in got.orderBy("at").collect()] == [(1.0, 2.48, "one line"), (3.0, 4.96, "two lines")]


def test_files(spark, tmp_path):
    for path, text in {"a/src/ep1.frame": "0.1000\n0.9000\n", "a/src/skip/ep2.frame": "0.5\n", "a/src/m.json": json.dumps({"source_type": "x", "quality_score": 0.5}, indent=1), "a/src/bad.json": "{"}.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(text)
    root = str(tmp_path / "a")
    found = files.media_files(spark, [root], [".frame"], ["skip"]).collect()
    assert [(r["source"], r["episode"]) for r in found] == [("src", "ep1")]
    assert [(r["episode"], r["frame_idx"], r["prob"]) for r in files.vad_frames(spark, f"{root}/src/ep1.frame").collect()] == [("ep1", 0, 0.1), ("ep1", 1, 0.9)]
    entries = files.json_documents(spark, root, files.ENTRY_DDL, recursive=True)
    assert [(r["source_type"], r["quality_score"], r["words_count"]) for r in entries.collect()] == [("x", 0.5, None)]
    sinks.write_manifest(entries, files.ENTRY_COLUMNS, str(tmp_path / "m"))
    assert spark.read.csv(str(tmp_path / "m"), header=True).columns == files.ENTRY_COLUMNS
    assert len(files.object_listing(spark, root).collect()) == 4
    probe = json.dumps({"streams": [{"codec_type": "video"}, {"codec_type": "audio", "codec_name": "aac", "sample_rate": "44100", "channels": 1}], "format": {"format_name": "mov,mp4", "duration": "12.5"}})
    got = files.audio_info(spark.createDataFrame([(1, probe)], "id long, probe string")).first()
    assert tuple(got) == (1, 44100, 1, 12.5, "aac", "mov")


def test_protocol(spark):
    xml = "<r><sTitle>T1</sTitle><sJSArrays>bk[0]=0;bk[2]=7;bk[1]=5;bk[2]=9;</sJSArrays></r>"
    df = spark.createDataFrame([("7", xml)], "id string, content string")
    pointers = protocols.time_pointers(df)
    assert [(r["idx"], r["sec"]) for r in pointers.orderBy("idx").collect()] == [(0, 0), (1, 5), (2, 9)]
    assert df.select(protocols.xml_title(F.col("content"))).first()[0] == "T1"
    pages = [("x/protocol_7_1_2_50_60_bulk.html", "<span id='txt_2'>second&nbsp;part</span>"), ("x/protocol_7_0_1_0_50_bulk.html", "lost<span id='txt_1'>first<br>line <b class='SPEAKER'>Name</b></span>"), ("x/protocol_7_9_9_-1_0_bulk.html", "no")]
    html = protocols.gathered_html(spark.createDataFrame(pages, "path string, content string"))
    text, slices = protocols.timed_transcript(protocols.transcript_parts(html), pointers)
    assert text.first()["text"] == "first\nline second part"
    assert sorted((r["ts"], r["start_loc"], r["end_loc"]) for r in slices.collect()) == [(5, 0, 11), (9, 11, 22)]


def docx(*paragraphs):
    """Paragraphs of ("t", seconds), ("o", id), ("/", id) and texts, as a DOCX."""
    w, made = "http://schemas.openxmlformats.org/wordprocessingml/2006/main", ""
    for p in paragraphs:
        made += "<w:p>"
        for x in p:
            if isinstance(x, str):
                made += f"<w:r><w:t>{x.replace('<', '&lt;').replace('>', '&gt;')}</w:t></w:r>"
            elif x[0] == "t":
                made += f'<w:bookmarkStart w:id="t{x[1]}" w:name="_ETM_Q1_{int(x[1] * 1000)}"/>'
            else:
                made += f'<w:bookmarkStart w:id="{x[1]}" w:name="ET_x"/>' if x[0] == "o" else f'<w:bookmarkEnd w:id="{x[1]}"/>'
        made += "</w:p>"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{made}</w:body></w:document>')
    return data.getvalue()


def test_docx(spark):
    file = docx(["head"], [("t", 1.5), "said ", "<< x >>", "hidden", "<< x >>", "shown"], [("o", 2), "title", ("/", 2), "end"], ["<< y >>", "lost"], ["<< x >> y"], ["kept", ("o", 3), "name"], [("t", 20.0), " "], [("t", 30.0), "late"], [("t", 32.0), "later"])
    assert protocols.docx_parts(file) == [(None, "head\n"), (1.5, "said shown\nend\nkept\n"), (20.0, " \n"), (30.0, "late\n"), (32.0, "later\n")]
    text, slices = protocols.docx_transcripts(spark.createDataFrame([("p", file)], "path string, content binary"))
    whole = "head\nsaid shown\nend\nkept\n \nlate\nlater\n"
    assert tuple(text.first()) == ("p", whole)
    got = sorted(map(tuple, slices.select("ts", "start_loc", "end_loc").collect()))
    assert [whole[a:b] for _, a, b in got] == ["said shown\nend\nkept\n \n", "late\nlater\n"] and got[-1][0] == 30.0


def test_encodings_feeds_and_other_sinks(spark, tmp_path):
    raw = [("שלום".encode(),), ("שלום".encode("cp1255"),), ("שלום".encode("utf-16"),), (b"\xef\xbb\xbfabc",), (None,)]
    df = spark.createDataFrame(raw, "b binary").select(captions.decoded("b").alias("t"))
    assert [r["t"] for r in df.collect()] == ["שלום", "שלום", "שלום", "abc", None]
    items = [("C & D", "l", "d", 2, "i2", None, "x", "20240102", "https://soundcloud.com/a?b=1&c=2"), ("C & D", "l", "d", 1, "i1", "T <1>", None, None, "u")]
    feed = feeds.feed_text(spark.createDataFrame(items, "channel_title string, channel_link string, channel_description string, at long, id string, title string, description string, uploaded string, url string").withColumn("feed", F.lit("f")), ["feed"]).first()["content"]
    root = ElementTree.fromstring(feed.encode())
    assert root.findtext("channel/title") == "C & D" and [i.findtext("title") for i in root.iter("item")] == ["T <1>", "No title"]
    assert [i.find("enclosure").get("type") for i in root.iter("item")] == ["video/mp4", "soundcloud"] and root.findall(".//item")[1].findtext("pubDate") == "Tue, 02 Jan 2024 00:00:00 +0000"
    index = spark.createDataFrame([(0, 3, 1.5)], "start_loc long, end_loc long, timestamp double")
    sinks.write_time_index(index, str(tmp_path / "i"))
    assert tuple(spark.read.csv(str(tmp_path / "i"), header=True, inferSchema=True).first()) == (0, 3, 1.5)
    rows = spark.createDataFrame([("s", "e", 1, "train"), ("s", "f", 2, "test")], "source string, episode string, v long, split string")
    sinks.write_entries(rows, str(tmp_path / "e"))
    assert sorted((r["source"], r["episode"], r["v"]) for r in spark.read.json(str(tmp_path / "e")).collect()) == [("s", "e", 1), ("s", "f", 2)]
    sinks.publish(rows, str(tmp_path / "p"), "split")
    assert spark.read.parquet(str(tmp_path / "p")).where("split = 'test'").first()["v"] == 2
    feeds.write_feed(rows.select("episode", "v"), str(tmp_path / "w"))
    assert spark.read.format("xml").option("rowTag", "item").load(str(tmp_path / "w")).count() == 2


def test_marks_before_the_first_time(spark):
    pointers = spark.createDataFrame([("7", i, s) for i, s in enumerate([0, 0, 50, 60])], "id string, idx long, sec long")
    html = "<div>no<span id='txt_0'>early </span><span id='txt_1'>too </span><span id='txt_2'>first </span><span id='txt_0'>on </span><span id='txt_9'>and on </span><span id='txt_3'>last</span></div>"
    pages = spark.createDataFrame([("7", html)], "id string, html string")
    text, slices = protocols.timed_transcript(protocols.transcript_parts(pages), pointers)
    assert text.first()["text"] == "early too first on and on last"
    assert sorted((r["ts"], r["start_loc"]) for r in slices.collect()) == [(47.0, 0), (50.0, 10), (60.0, 26)]
    assert protocols.transcript_parts(pages, known=protocols.ELEMENTS).count() > 0
    with pytest.raises(Exception, match="unknown element b"):
        protocols.transcript_parts(spark.createDataFrame([("7", "<b>x</b>")], "id string, html string"), known=protocols.ELEMENTS).collect()


def test_feed(spark, tmp_path):
    item = "<item><title>{t}</title><pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate><guid>{g}</guid>{e}</item>"
    link = '<enclosure url="http://x.org/{g}.mp3" type="audio/mpeg">v</enclosure>'
    for name, rows in {"a": ["1", "2"], "b": ["1", "3"]}.items():
        (tmp_path / f"{name}.xml").write_text("<rss><channel>" + "".join(item.format(t=f"T: {g}", g=f"{name}{g}", e=link.format(g=g) if g != "3" else "") for g in rows) + "</channel></rss>")
    items = feeds.feed_items(spark, str(tmp_path / "*.xml"))
    assert items.count() == 4 and {r["description"] for r in items.collect()} == {"None"}
    got = sorted((r["name"], r["url"], r["extension"]) for r in feeds.downloads(items).collect())
    assert got == [("2024.01.02 T 1", "http://x.org/1.mp3", "mp3"), ("2024.01.02 T 2", "http://x.org/2.mp3", "mp3")]


def test_vtt_sink(spark):
    df = spark.createDataFrame([("e", 1.25, 2.0, "b"), ("e", 0.0, 1.0, "a")], "id string, start double, end double, text string")
    assert sinks.vtt_text(df, ["id"]).first()["content"] == "WEBVTT\n\n00:00:00.000 --> 00:00:01.000\na\n\n00:00:01.250 --> 00:00:02.000\nb\n"
    frames = spark.createDataFrame([("e", 1, 0.5), ("e", 0, 0.25)], "id string, frame_idx long, prob double")
    assert sinks.frame_text(frames, ["id"]).first()["content"] == "0.2500\n0.5000\n"


def test_word_stream_is_the_batch_window(spark, tmp_path):
    from cantilena.operators.quality import trailing_window

    rows = [(f"e{i % 3}", float(i * 3 % 400 + i), 0.5 + i % 5, [0.2, 0.5, 0.9][i % 3]) for i in range(200)]
    df = spark.createDataFrame(rows, "entry string, end double, duration double, prob double")
    df.repartition(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = stream.word_window_stream(source).writeStream.format("memory").queryName("words_out").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination()
    tidy = lambda d: sorted((r["entry"], round(r["end"], 6), r["ratio"] and round(r["ratio"], 6), r["mean_prob"] and round(r["mean_prob"], 6)) for r in d.select("entry", "end", "ratio", "mean_prob").collect())
    assert str(tidy(spark.table("words_out"))) == str(tidy(trailing_window(df)))


def test_only_new_files_are_processed(spark, tmp_path):
    seen = []
    sink = lambda df, n: seen.append(sorted(r["x"] for r in df.collect()))
    for part in ([1, 2], [3]):
        spark.createDataFrame([(x,) for x in part], "x long").write.mode("append").parquet(str(tmp_path / "in"))
        stream.process_new(spark, str(tmp_path / "in"), "x long", sink, str(tmp_path / "ck"))
    assert seen == [[1, 2], [3]]
