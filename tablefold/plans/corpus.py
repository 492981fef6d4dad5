"""The whole annotation job: landed files in, tables with types, domains and statistics out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefold import sinks, wide_tables
from tablefold.functions import text
from tablefold.operators import domain, filters, match, names, privacy, stats
from tablefold.operators.joins import sized_join
from tablefold.operators.long_files import parse_lines
from tablefold.operators.parse import Parsed, cells_of, infer_dtypes, parse_files
from tablefold.session import cut_lineage

_ORIGIN = ["topic", "file_name", "url_pos", "url", "license"]


@dataclass
class Corpus:
    """An annotation job over all topics at once; its tables are keyed by ``file_id``.

    ``files(topic, file_name, file_id, content)`` meet the ``manifest(topic,
    url_pos, url, file_name)`` by name; files too long for one row come as
    ``long_files(topic, file_name, file_id, line_pos, line)``. ``domains`` are
    the domain votes of types, taken from the lists in ``ontology`` unless given.

    Tables are planned when first asked for. ``cut`` stores those that several
    others read (licensed URLs, parsed files, columns, tables, annotations), so that
    content is read and parsed once: ``session.cut_lineage``, or a function that
    writes a table and reads it back. ``name_mode`` and ``name_base`` say how landed
    files were named (``dedup_file_names``). ``only`` limits the job to some
    ``(topic, url_pos)``; names still come from the whole manifest. With ``vectors(vec_id,
    vec)`` the ``word_vectors`` hold ``word, vec_id`` instead of ``word, vec``.
    """

    files: DataFrame
    manifest: DataFrame
    licenses: DataFrame
    ontology: DataFrame
    word_vectors: DataFrame
    dim: int
    domain_votes: DataFrame | None = None
    long_files: DataFrame | None = None
    type_vectors: DataFrame | None = None
    threshold: float = match.SIMILARITY_THRESHOLD
    seed: int = 0
    cut: Callable[[DataFrame], DataFrame] = cut_lineage
    name_mode: str = "exact"
    name_base: str = "cut"
    only: DataFrame | None = None
    vectors: DataFrame | None = None

    @cached_property
    def named(self) -> DataFrame:
        """The manifest with a unique file name per URL."""
        named = names.dedup_file_names(self.manifest, self.name_mode, self.name_base)
        if self.only is not None:
            named = named.join(self.only.select("topic", "url_pos").distinct(), ["topic", "url_pos"], "left_semi")
        return self.cut(named)

    @cached_property
    def licensed(self) -> DataFrame:
        """Manifest rows under a named license. Needs no file content."""
        kept = filters.filter_licensed(self.named, self.licenses)
        return self.cut(kept.select("topic", F.col("unique_name").alias("file_name"), "url_pos", "url", "license"))

    @cached_property
    def _kept_files(self) -> DataFrame:
        return sized_join(self.files, self.licensed, ["topic", "file_name"])

    @cached_property
    def _kept_long(self) -> DataFrame | None:
        if self.long_files is None:
            return None
        found = self.long_files.select("topic", "file_name", "file_id").distinct()
        return found.join(self.licensed, ["topic", "file_name"]).select("file_id", *_ORIGIN)

    @cached_property
    def origins(self) -> DataFrame:
        """``file_id`` with topic, URL and license of every licensed file that has landed."""
        short = self._kept_files.select("file_id", *_ORIGIN)
        return self.cut(short if self._kept_long is None else short.unionByName(self._kept_long))

    @cached_property
    def parsed(self) -> Parsed:
        short = parse_files(self._kept_files.select("file_id", "content"), cut=self.cut)
        if self._kept_long is None:
            return short
        lines = self.long_files.drop("topic", "file_name")
        long = parse_lines(sized_join(lines, self._kept_long.select("file_id"), ["file_id"]), cut=self.cut)
        both = {n: getattr(short, n).unionByName(getattr(long, n)) for n in ("files", "columns", "rows", "rejects")}
        return Parsed(**both)

    @cached_property
    def missing(self) -> DataFrame:
        """Licensed URLs whose file has not landed."""
        return self.licensed.join(self.origins.select("topic", "url_pos"), ["topic", "url_pos"], "left_anti")

    @property
    def rejects(self) -> DataFrame:
        """``(topic, url, file_id, stage, reason)`` of licensed files that are not there or cannot be parsed."""
        unread = self.parsed.rejects.join(self.origins, "file_id").select("topic", "url", "file_id", "stage", "reason")
        absent = self.missing.select(
            "topic", "url", F.lit(None).cast(dict(unread.dtypes)["file_id"]).alias("file_id"),
            F.lit("missing").alias("stage"), F.lit("not landed").alias("reason"),
        )
        return unread.unionByName(absent)

    @cached_property
    def _all_columns(self) -> DataFrame:
        return self.cut(infer_dtypes(self.parsed.columns, cells_of(self.parsed.rows)))

    @cached_property
    def social(self) -> DataFrame:
        """``file_id`` of tables left out for their social-platform headers."""
        return filters.social_tables(self._all_columns)

    @cached_property
    def columns(self) -> DataFrame:
        return self._all_columns.join(self.social, "file_id", "left_anti")

    @cached_property
    def tables(self) -> DataFrame:
        """Kept tables with their shape, number in the topic, and the name of their own file."""
        shaped = self.origins.join(self.parsed.files, "file_id").join(self.social, "file_id", "left_anti")
        named = shaped.withColumn("output_name", F.concat(text.strip_extension(F.col("file_name")), F.lit(".parquet")))
        return self.cut(stats.assign_table_ids(named))

    @cached_property
    def annotations(self) -> DataFrame:
        vectors = self.type_vectors
        if vectors is None:
            vectors = match.embed_types(self.ontology, self.word_vectors, self.dim, self.vectors, firsts=True)
        exact = match.match_syntactic(self.columns, self.ontology)
        alike = match.match_semantic(self.columns, self.ontology, vectors, self.word_vectors, self.dim, self.threshold, vectors=self.vectors)
        return self.cut(match.with_entries(exact.unionByName(alike), self.ontology))

    @cached_property
    def domains(self) -> DataFrame:
        votes = domain.type_domains(self.ontology) if self.domain_votes is None else self.domain_votes
        return domain.table_domain(self.annotations, votes)

    @cached_property
    def types(self) -> DataFrame:
        return filters.column_types(self.annotations)

    @cached_property
    def replaced(self) -> DataFrame:
        return privacy.replaced_columns(self.types)

    @cached_property
    def rows(self) -> DataFrame:
        """Rows of the kept tables with personal data replaced."""
        kept = sized_join(self.parsed.rows, self.social, ["file_id"], "left_anti")
        return privacy.anonymize_rows(kept, self.replaced, self.seed)

    @cached_property
    def staged(self) -> DataFrame:
        """One row per manifest URL with the stages it reached."""
        yes = F.lit(True)
        licensed = self.licensed.select("topic", "url_pos", yes.alias("licensed"))
        landed = self.origins.select("topic", "url_pos", "file_id", yes.alias("landed"))
        parsed = self.parsed.files.select("file_id", yes.alias("parsed"))
        return (
            self.named.select("topic", "url_pos")
            .join(licensed, ["topic", "url_pos"], "left")
            .join(landed, ["topic", "url_pos"], "left")
            .join(parsed, "file_id", "left")
            .join(self.social.withColumn("social", yes), "file_id", "left")
            .fillna(False, ["licensed", "landed", "parsed", "social"])
            .select("topic", "licensed", "landed", "parsed", "social")
        )


def table_metadata(corpus: Corpus) -> DataFrame:
    """``(file_id, table_id, topic, metadata)``: everything known about each table as JSON.

    Column maps are gathered per table and are as long as the table is wide.
    """
    key = "file_id"
    shares = stats.dtype_shares(corpus.columns).groupBy(key).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("dtype", "share")))).alias("dtypes_percentages")
    )
    dtypes = corpus.columns.groupBy(key).agg(_header_map(F.lit(True), F.col("dtype"), "dtypes"))
    maps = []
    for ontology in stats.ONTOLOGIES:
        for method in stats.METHODS:
            mine = (F.col("ontology") == ontology) & (F.col("method") == method)
            maps.append(_header_map(mine, F.struct("cleaned_label", *match.ENTRY), f"{ontology}_{method}_column_types"))
            if method == "semantic":
                maps.append(_header_map(mine, F.col("similarity"), f"{ontology}_semantic_similarities"))
    joined = (
        corpus.tables.select(
            key, "table_id", "topic", F.col("url").alias("table_csv_url"), F.col("n_rows").alias("number_rows"),
            F.col("n_columns").alias("number_columns"), "license",
        )
        .join(dtypes, key, "left")
        .join(shares, key, "left")
        .join(corpus.annotations.groupBy(key).agg(*maps), key, "left")
        .join(privacy.anonymized_headers(corpus.replaced), key, "left")
        .withColumn("anonymized_columns", F.coalesce("anonymized_columns", F.array().cast("array<string>")))
    )
    kind = F.concat_ws("_", "ontology", "method")
    votes = corpus.domains.groupBy(key).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(kind.alias("kind"), "domain")))).alias("table_domain")
    )
    joined = joined.join(votes, key, "left")
    described = [c for c in joined.columns if c not in (key, "topic")]
    return joined.select(key, "table_id", "topic", F.to_json(F.struct(*described)).alias("metadata"))


def _header_map(keep: Column, value: Column, out: str) -> Column:
    """Aggregate: header to value of the rows to keep, in column order."""
    entries = F.sort_array(F.collect_list(F.when(keep, F.struct("col_idx", "header", value.alias("v")))))
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["header"], e["v"]))).alias(out)


def _counts_map(df: DataFrame, name: str, count: str, out: str) -> DataFrame:
    pairs = F.sort_array(F.collect_list(F.struct(name, count)))
    return df.groupBy("topic").agg(F.map_from_entries(pairs).alias(out))


def topic_stats(corpus: Corpus) -> DataFrame:
    """One row per topic with all counts; its lists per table are in ``topic_series``.

    The maps are as long as there are licenses, types or top values.
    """
    topics = corpus.staged.select("topic").distinct()
    placed = corpus.tables.select("file_id", "topic", "table_id")
    annotated = corpus.annotations.join(placed, "file_id")
    counts = stats.type_counts(annotated, "topic").withColumn("kind", F.concat_ws("_", "ontology", "method"))
    per_kind = _nested_counts(counts, "kind", "cleaned_label", "n_columns", "annotation_type_counts")
    bias = privacy.bias_values_of_rows(corpus.rows, corpus.types).join(placed, "file_id")
    top = privacy.bias_top_values(bias, ["table_id", "col_idx", "row_idx"], groups=("topic",))
    typed = corpus.types.join(placed, "file_id")
    return (
        stats.funnel(corpus.staged)
        .join(_counts_map(stats.license_counts(corpus.licensed), "license", "n_files", "licenses"), "topic", "left")
        .join(_counts_map(stats.dtype_counts(corpus.columns.join(placed, "file_id")), "dtype", "n_columns", "dtype_counts"), "topic", "left")
        .join(_counts_map(privacy.personal_counts(corpus.replaced.join(placed, "file_id"), topics), "personal_type", "n_columns", "pii_column_counts"), "topic", "left")
        .join(_counts_map(privacy.bias_counts(typed, topics), "bias_type", "n_columns", "dbpedia_bias_column_count"), "topic", "left")
        .join(_nested_counts(top, "bias_type", "value", "n", "dbpedia_bias_type_values"), "topic", "left")
        .join(per_kind, "topic", "left")
    )


def _nested_counts(df: DataFrame, outer: str, inner: str, count: str, out: str) -> DataFrame:
    pairs = F.sort_array(F.collect_list(F.struct(inner, count)))
    inside = df.groupBy("topic", outer).agg(F.map_from_entries(pairs).alias("m"))
    return inside.groupBy("topic").agg(F.map_from_entries(F.collect_list(F.struct(outer, "m"))).alias(out))


def topic_series(corpus: Corpus, chunk_tables: int = stats.CHUNK_TABLES) -> DataFrame:
    """``(topic, series, name, chunk, values)``: lists over the tables of a topic, as JSON, in chunks of table ids."""
    placed = corpus.tables.select("file_id", "topic", "table_id", "n_rows", "n_columns")
    ids = placed.select("file_id", "topic", "table_id")
    listed = lambda df, name, value, ties=(): stats.chunked_list(
        df.withColumn("name", name), ["topic", "name"], "table_id", value, "values", ties, chunk_tables
    )
    kind = F.concat_ws("_", "ontology", "method")
    domains = stats.table_domains_or_none(ids, corpus.domains)
    annotated = stats.annotated_columns(ids, corpus.annotations).join(ids, "file_id")
    semantic = corpus.annotations.filter(F.col("method") == "semantic").join(ids, "file_id")
    parts = {
        "row_counts": listed(placed, F.lit(""), F.col("n_rows")),
        "column_counts": listed(placed, F.lit(""), F.col("n_columns")),
        "dtypes_percentages": listed(stats.dtype_shares(corpus.columns).join(ids, "file_id"), F.col("dtype"), F.col("share")),
        "table_domains": listed(domains, kind, F.struct("domain")),
        "number_of_annotated_columns": listed(annotated, kind, F.col("n_columns")),
        "annotation_type_similarities": listed(
            semantic, F.concat_ws(".", kind, "cleaned_label"), F.col("similarity"), ("col_idx",)
        ),
    }
    series = None
    for name, part in parts.items():
        part = part.select("topic", F.lit(name).alias("series"), "name", "chunk", F.to_json("values").alias("values"))
        series = part if series is None else series.unionByName(part)
    return series


def write_corpus(corpus: Corpus, path: str) -> None:
    """All tables of the corpus as Parquet by topic, and each as a wide file of its own; statistics as JSON, last.

    Topics written before stay unless this corpus has them too; writing a corpus
    again changes nothing.
    """
    topics = corpus.tables.select("file_id", "topic")
    sinks.write_partitioned(corpus.tables, f"{path}/tables")
    for name in ("columns", "annotations", "domains", "replaced", "rows"):
        sinks.write_partitioned(getattr(corpus, name).join(topics, "file_id"), f"{path}/{name}")
    sinks.write_partitioned(table_metadata(corpus), f"{path}/metadata")
    wide = corpus.tables.select("file_id", "topic", F.col("output_name").alias("name"))
    typed = wide_tables.columns_as_written(corpus.columns, corpus.replaced)
    wide_tables.write_tables(corpus.rows, typed, wide, f"{path}/wide", table_metadata(corpus))
    sinks.write_partitioned(corpus.rejects, f"{path}/rejects")
    sinks.write_partitioned(topic_series(corpus), f"{path}/topic_series")
    sinks.write_topic_stats(topic_stats(corpus), f"{path}/topic_stats")
