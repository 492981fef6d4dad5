import json

import pytest
from pyspark.sql import functions as F

from tablefold import sinks
from tablefold.operators import names, ontology
from tablefold.operators.long_files import parse_lines
from tablefold.operators.parse import parse_files
from tablefold.plans.corpus import Corpus, write_corpus
from tablefold.session import cut_lineage
from tablefold.sources import landed, ontologies
from tablefold.plans import corpus as plan
from tablefold.plans import topic_counts
from tablefold.streaming.incremental import count_landed, process_pending

GRAPH = {
    "@graph": [
        {"@id": "schema:givenName", "@type": "rdf:Property", "rdfs:comment": "c", "rdfs:label": "givenName",
         "schema:domainIncludes": {"@id": "schema:Person"}, "schema:rangeIncludes": [{"@id": "schema:Text"}]},
        {"@id": "schema:email", "@type": "rdf:Property", "rdfs:comment": "c", "rdfs:label": {"@value": "email", "@language": "en"},
         "schema:domainIncludes": [{"@id": "schema:Person"}, {"@id": "schema:Place"}]},
        {"@id": "schema:identifier", "@type": "rdf:Property", "rdfs:comment": "c", "rdfs:label": "identifier"},
    ]
}


def test_graph_ontology_and_snapshots(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps(GRAPH, indent=1))
    built = ontology.build_graph_ontology(ontologies.read_jsonld(spark, str(tmp_path / "g.json")))
    rows = {r.cleaned_label: r for r in built.collect()}
    assert {k: r.type_pos for k, r in rows.items()} == {"email": 0, "given name": 1, "id": 2}
    assert rows["email"].domain == ["schema:Person", "schema:Place"] and rows["given name"].domain == ["schema:Person"]
    assert rows["id"].domain is None
    for day in ("20240101", "20240102"):
        ontologies.write_ontology(built, str(tmp_path / "o"), day)
    assert ontologies.read_ontology(spark, str(tmp_path / "o"), "20240101").count() == 3
    assert ontology.assert_unique_labels(built).count() == 0


def test_sparql_pages(spark, tmp_path):
    space = "http://dbpedia.org/ontology/"
    value = lambda **kw: {k: {"type": "uri", "value": v} for k, v in kw.items()}
    pages = [
        [value(property=space + "birthPlace", domain="D1"), value(property=space + "birthPlace", domain="D2")],
        [value(property="http://other/x"), value(property=space + "city")],
    ]
    for i, page in enumerate(pages):
        (tmp_path / f"page{i}.json").write_text(json.dumps({"results": {"bindings": page}}))
    built = ontology.build_property_ontology(ontologies.read_sparql_json(spark, str(tmp_path)))
    assert {r.cleaned_label: r.domain for r in built.collect()} == {"birth place": ["D1", "D2"], "city": []}


def test_topics_and_search(spark, tmp_path):
    (tmp_path / "topics.json").write_text('["b c", "a"]')
    topics = landed.read_topics(spark, str(tmp_path / "topics.json"))
    assert [(r.topic_pos, r.topic) for r in landed.processing_order(topics).collect()] == [(1, "a"), (0, "b c")]
    folder = tmp_path / "search" / "a"
    folder.mkdir(parents=True)
    hits = [{"html_url": "https://h/o/r/blob/m/x.csv"}] * 2
    (folder / "1.json").write_text(json.dumps({"total_count": 2, "items": hits}))
    got = landed.flatten_search(landed.read_search(spark, str(tmp_path / "search")), "topic").collect()
    assert [(r.topic, r.raw_url) for r in got] == [("a", "https://h/o/r/blob/m/x.csv?raw=true")] * 2


def test_snapshot_is_built_when_absent(spark, tmp_path):
    table = spark.createDataFrame([("schema", 0, "x")], "ontology string, type_pos bigint, cleaned_label string")
    path = str(tmp_path / "o")
    with pytest.raises(ValueError):
        ontologies.read_ontology(spark, path, "20240101")
    assert ontologies.read_ontology(spark, path, "20240101", lambda: table).count() == 1
    assert ontologies.read_ontology(spark, path, "20240101").count() == 1
    with pytest.raises(ValueError):
        ontologies.read_ontology(spark, path, "20240102")


CONTENTS = {
    "mark.csv": b"\xef\xbb\xbfid,name\n1,a\n", "returns.csv": b'a,b\r\n"x\r\ny",1\r\nz,2\r\n', "old.csv": b"a,b\r1,2\r3,4\r",
    "mixed.csv": b'a,b\n"p\rq\ns",1\n', "latin.csv": b"a,b\n\xe9,1\n", "plain.csv": b"a,a\n1,2", "long.csv": b"a,b\n" + b"x" * 140_000 + b",1\n",
}


def test_both_readers_give_the_same_tables(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for name, content in CONTENTS.items():
        (tmp_path / "t" / name).write_bytes(content)
    path = str(tmp_path)
    short = parse_files(landed.read_files(spark, path).select("file_id", "content"))
    long = parse_lines(landed.read_long_files(spark, path, 0).drop("topic", "file_name"))
    name = F.element_at(F.split("file_id", "/"), -1)
    for table in ("files", "columns", "rows", "rejects"):
        one, two = (sorted(map(str, getattr(p, table).withColumn("file_id", name).collect())) for p in (short, long))
        assert one == two, table
    rows = {(r.file_id.split("/")[-1], r.row_idx): r.fields for r in short.rows.collect()}
    assert rows["returns.csv", 0] == ["x\r\ny", "1"] and rows["mixed.csv", 0] == ["p\rq\ns", "1"] and rows["old.csv", 1] == ["3", "4"]
    assert len(rows["long.csv", 0][0]) == 140_000
    assert {r.header for r in short.columns.filter(F.col("file_id").endswith("mark.csv")).collect()} == {"id", "name"}
    assert [r.reason for r in short.rejects.collect()] == ["not UTF-8"]


def test_wide_table_with_odd_headers(spark, tmp_path):
    heads = ["ID", "id", "a`b", "x.y", "a,b"]
    columns = spark.createDataFrame([(1, i, h, "int64") for i, h in enumerate(heads)], "file_id int, col_idx int, header string, dtype string")
    rows = spark.createDataFrame([(1, 0, ["1", "2", "3", "4", "5"])], "file_id int, row_idx bigint, fields array<string>")
    sinks.write_wide(rows, columns, 1, str(tmp_path / "w"), {"table_id": 7})
    back = spark.read.parquet(str(tmp_path / "w"))
    assert list(back.first()) == [1, 2, 3, 4, 5] and sinks.read_table_metadata(back) == {"table_id": 7}
    assert [f.metadata[sinks.HEADER_KEY] for f in back.schema.fields] == heads


def test_maps_and_metrics_are_replaced_by_topic(spark, tmp_path):
    path = str(tmp_path / "m")
    manifest = spark.createDataFrame([("a b", 0, "u0", "x.csv"), ("c", 0, "u1", "y.csv")], "topic string, url_pos bigint, url string, file_name string")
    named = names.dedup_file_names(manifest)
    sinks.write_manifest(named, path)
    sinks.write_manifest(named.filter("topic = 'c'"), path)
    assert sorted((r.topic, r.url, r.file_name) for r in spark.read.json(path).collect()) == [("a b", "u0", "x.csv"), ("c", "u1", "y.csv")]
    topics = spark.createDataFrame([("a b", 0), ("c", 1)], "topic string, topic_pos int")
    for _ in range(2):
        sinks.write_metrics(names.extraction_metrics(topics, manifest), str(tmp_path / "n"))
    assert sorted((r.topic, r.running_files) for r in spark.read.json(str(tmp_path / "n")).collect()) == [("a b", 2), ("c", 1)]


def land(tmp_path):
    files = {
        "people": {"p.csv": "email,name,id\na@b.c,Ann,1\nd@e.f,Bob,2\n", "s.csv": "tweet,id\nhi,1\n", "bad.csv": "\n"},
        "big city": {"c.csv": "city,id\n" + "".join(f'"x{i}, ""y""\nz",{i}\n' for i in range(50)), "u.csv": "id,n\n1,2\n"},
    }
    for topic, named in files.items():
        for folder in ("files", "manifests"):
            (tmp_path / folder / topic).mkdir(parents=True)
        for name, content in named.items():
            (tmp_path / "files" / topic / name).write_text(content)
        owner = {"u.csv": "closed"}
        urls = [f"https://h/{owner.get(n, 'o')}/r/blob/m/{n}" for n in named]
        (tmp_path / "manifests" / topic / "urls.txt").write_text("\n".join(urls) + "\n")
    licenses = [{"owner": "o", "repo": "r", "status": 200, "license": {"name": "MIT License"}},
                {"owner": "closed", "repo": "r", "status": 200, "license": {"name": "Other"}}]
    (tmp_path / "licenses.json").write_text("\n".join(map(json.dumps, licenses)))


def test_whole_job(spark, tmp_path):
    land(tmp_path)
    labels = [("schema", 0, "email", ["Person"]), ("schema", 1, "id", ["Thing"]), ("schema", 2, "name", ["Person"]),
              ("dbpedia", 0, "city", ["Place"])]
    types = spark.createDataFrame(labels, "ontology string, type_pos bigint, cleaned_label string, domain array<string>")
    words = spark.createDataFrame(
        [("email", [1.0, 0.0, 0.0]), ("name", [0.0, 1.0, 0.0]), ("city", [0.0, 0.0, 1.0]), ("id", [-1.0, -1.0, -1.0])],
        "word string, vec array<float>",
    )
    source = str(tmp_path / "files")
    results = []
    for limit in (10_000_000, 60):  # whole files only, then the larger ones as lines
        job = Corpus(
            files=landed.read_files(spark, source, limit), long_files=landed.read_long_files(spark, source, limit),
            manifest=landed.read_manifest(spark, str(tmp_path / "manifests")),
            licenses=landed.read_licenses(spark, str(tmp_path / "licenses.json")),
            ontology=types, word_vectors=words, dim=3, cut=cut_lineage,
        )
        tables = {(r.topic, r.url.split("/")[-1]): (r.table_id, r.n_rows, r.n_columns) for r in job.tables.collect()}
        assert tables == {("people", "p.csv"): (0, 2, 3), ("big city", "c.csv"): (0, 50, 2)}
        rows = sorted((tuple(r.fields) for r in job.rows.collect()), key=str)
        assert ("x7, \"y\"\nz", "7") in rows and not any("a@b.c" in r or "Ann" in r for r in rows)
        results.append(sorted((r.header, r.ontology, r.method, r.cleaned_label) for r in job.annotations.collect()))
    assert results[0] == results[1] and ("city", "dbpedia", "semantic", "city") in results[0]

    (tmp_path / "manifests" / "people" / "urls.txt").open("a").write("https://h/o/r/blob/m/gone.csv\n")
    job = Corpus(
        files=landed.read_files(spark, source), manifest=landed.read_manifest(spark, str(tmp_path / "manifests")),
        licenses=landed.read_licenses(spark, str(tmp_path / "licenses.json")), ontology=types, word_vectors=words, dim=3, cut=cut_lineage,
    )
    out = str(tmp_path / "out")
    write_corpus(job, out)
    stats = {r["topic"]: r for r in map(json.loads, (x.value for x in spark.read.text(out + "/topic_stats").collect()))}
    assert stats["people"]["pii_column_counts"]["email"] == 1 and stats["people"]["pii_column_counts"]["name"] == 1
    assert (stats["people"]["files"], stats["people"]["landed_files"]) == (4, 3)
    rejects = sorted((r.url.split("/")[-1], r.stage) for r in spark.read.parquet(out + "/rejects").collect())
    assert rejects == [("bad.csv", "parse"), ("gone.csv", "missing")]
    assert stats["people"]["removed_social_tables"] == 1 and stats["big city"]["written_tables"] == 1
    assert sum(stats["big city"]["dbpedia_bias_type_values"]["city"].values()) == 50
    assert {r.topic for r in sinks.read_finished(spark, out + "/topic_stats").collect()} == {"people", "big city"}
    meta = [json.loads(r.metadata) for r in spark.read.parquet(out + "/metadata").collect()]
    assert {m["number_rows"] for m in meta} == {2, 50}

    file_id = job.columns.filter("header = 'city'").first().file_id
    sinks.write_wide(job.rows, job.columns, file_id, out + "/wide", {"table_id": 0})
    back = spark.read.parquet(out + "/wide")
    assert back.dtypes == [("city", "string"), ("id", "bigint")] and back.count() == 50
    assert sinks.read_table_metadata(back) == {"table_id": 0}


def test_batches_keep_earlier_topics(spark, tmp_path):
    land(tmp_path)
    types = spark.createDataFrame([("schema", 0, "id", ["Thing"])], "ontology string, type_pos bigint, cleaned_label string, domain array<string>")
    words = spark.createDataFrame([("id", [1.0])], "word string, vec array<float>")
    manifest = landed.read_manifest(spark, str(tmp_path / "manifests")).drop("raw_url")
    out, landing = str(tmp_path / "out"), str(tmp_path / "land")

    def handle(batch):
        write_corpus(Corpus(
            files=landed.read_files(spark, str(tmp_path / "files")), manifest=batch, ontology=types, word_vectors=words, dim=1,
            licenses=landed.read_licenses(spark, str(tmp_path / "licenses.json")),
        ), out)

    def state():
        stats = spark.read.json(out + "/topic_stats")
        return sorted(map(str, stats.select("topic", "files", "written_tables").collect())), spark.read.parquet(out + "/tables").count()

    for topic in ("people", "big city"):
        manifest.filter(F.col("topic") == topic).write.mode("append").parquet(landing)
        process_pending(spark, landing, out + "/topic_stats", str(tmp_path / "ckpt"), handle)
    first = state()
    assert len(first[0]) == 2 and first[1] == 2
    handle(manifest)  # all of it once more
    assert state() == first


def test_only_unfinished_topics_are_handled(spark, tmp_path):
    rows = [("a", 0, "u", "x.csv"), ("b", 0, "u", "x.csv")]
    manifest = spark.createDataFrame(rows, "topic string, url_pos bigint, url string, file_name string")
    manifest.write.parquet(str(tmp_path / "land"))
    sinks.write_topic_stats(spark.createDataFrame([("a", 1)], "topic string, files int"), str(tmp_path / "done"))
    seen = []
    process_pending(spark, str(tmp_path / "land"), str(tmp_path / "done"), str(tmp_path / "ckpt"),
                    lambda batch: seen.extend(r.topic for r in batch.collect()))
    assert seen == ["b"]


def test_metadata_that_is_there_stays(spark):
    one = sinks.with_table_metadata(spark.range(1), {"a": 1})
    assert sinks.read_table_metadata(sinks.with_table_metadata(one.select(F.col("id")), {"a": 2})) == {"a": 1}


def test_batches_of_a_growing_topic_add_up(spark, tmp_path):
    land(tmp_path)
    labels = [("schema", 0, "email", ["Person"]), ("schema", 1, "id", ["Thing"]), ("schema", 2, "name", ["Person"]), ("dbpedia", 0, "city", ["Place"])]
    types = spark.createDataFrame(labels, "ontology string, type_pos bigint, cleaned_label string, domain array<string>")
    vectors = [("email", [1.0, 0.0, 0.0]), ("name", [0.0, 1.0, 0.0]), ("city", [0.0, 0.0, 1.0]), ("id", [-1.0, -1.0, -1.0])]
    words = spark.createDataFrame(vectors, "word string, vec array<float>")
    manifest = landed.read_manifest(spark, str(tmp_path / "manifests")).drop("raw_url").cache()
    files = landed.read_files(spark, str(tmp_path / "files")).cache()
    licenses = landed.read_licenses(spark, str(tmp_path / "licenses.json"))
    job = lambda **kw: Corpus(licenses=licenses, ontology=types, word_vectors=words, dim=3, **kw)
    landing, out, made = str(tmp_path / "land"), str(tmp_path / "out"), []

    def make(known, batch, number):
        names = [r.file_name for r in batch.select("file_name").distinct().collect()]
        made.append((number, sorted(names)))
        return job(files=files.filter(F.col("file_name").isin(names)), manifest=known, only=batch)

    def rows(stats):
        return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in stats.collect())

    def land_more(part):
        part.write.mode("append").parquet(landing)
        count_landed(spark, landing, out, str(tmp_path / "ckpt"), make)
        return topic_counts.read_counts(spark, out + "/counts")

    half = F.col("url_pos") % 2
    land_more(manifest.filter(half == 0))
    counts = land_more(manifest.filter(half == 1))
    assert len(made) == 2 and not set(made[0][1]) & set(made[1][1])  # only new files
    full = plan.topic_stats(job(files=files, manifest=manifest))
    expected = rows(full)
    assert rows(topic_counts.stats_of(counts).select(*full.columns)) == expected
    assert topic_counts.similarity_spread(counts).filter("p500 = 1.0").count() >= 1
    again = land_more(manifest)  # landed once more
    assert len(made) == 2
    assert rows(topic_counts.stats_of(again).select(*full.columns)) == expected
