"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cauce.functions import (
    count_line,
    parse_event_time,
    rate_per_100k,
    safe_ratio,
    timestamp_text,
    to_code,
    to_count,
    to_key,
    to_name,
)
from cauce.operators import cleaning, dedup, enrichment, ordering, paging, reports, stored
from cauce.operators.reconcile import reconcile
from cauce.operators.shape import metrics_frame, to_metrics
from cauce.plans import run_all, run_clean, run_enrich, run_ingest
from cauce.schemas import FILL_VALUES, KEY, RAW
from cauce.shared import shared_dir, written
from cauce.sinks import commit_table, write_report, write_sample, write_table
from cauce.sources import (
    html_table,
    land,
    project_fields,
    read_clean,
    read_delimited,
    read_json_array,
    read_landing,
    read_page_files,
    read_pages,
    read_xml_rows,
    records_from_json,
    unreadable_counts,
)
from checks import fixtures
from checks.fixtures import dimensions, facts, fields, run_time, table
from checks.stand_in import StoredPages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources -----------------------------------------------------------------


def raw_records(spark, sf_dir, **options) -> DataFrame:
    path = fixtures.page_files(spark, sf_dir)
    options = {"path": path, "limit": str(fixtures.PAGE_SIZE), "pagesPerTask": "4", **options}
    return read_pages(spark, RAW, StoredPages, **options)


@query
def src_rest_pages(spark, sf_dir):
    return raw_records(spark, sf_dir)


@query
def src_rest_keys(spark, sf_dir):
    """Pages by key; the ids are positions all the same."""
    return raw_records(spark, sf_dir, key=":id")


@query
def src_json_pretty_split(spark, sf_dir):
    """Arrays with their objects over many lines, read in parts."""
    schema = fields(cod_depto="long", nombre="string", total="long", partes=fields(a="long", b="string"))

    def make(path):
        made = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("cod_depto"),
            F.concat("c_name", F.lit(' {"[,]"}\n\\ '), "c_mktsegment").alias("nombre"),
            F.floor(F.col("c_acctbal") * 100).alias("total"),
            F.struct(F.col("c_nationkey").cast("long").alias("a"), F.lit("}{").alias("b")).alias("partes"),
        )
        chunk = F.floor(F.col("cod_depto") / fixtures.PAGE_SIZE)
        pretty = made.groupBy(chunk.alias("chunk")).agg(
            F.to_json(F.sort_array(F.collect_list(F.struct(*made.columns))), {"pretty": "true"}).alias("value")
        )
        pretty.write.partitionBy("chunk").text(path)

    path = fixtures.made_once(spark, sf_dir, "json-pretty", make)
    return read_json_array(spark, path, schema, split=True).select("cod_depto", "nombre", "total", "partes.a", "partes.b")


@query
def src_csv_lines_split(spark, sf_dir):
    """Delimited files with line breaks in their fields, read in parts."""
    schema = fields(cod_depto="long", nombre="string", saldo="double")

    def make(path):
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("cod_depto"),
            F.concat(F.lit('"'), "c_name", F.lit('",\n\n'), "c_mktsegment").alias("nombre"),
            F.col("c_acctbal").alias("saldo"),
        ).write.option("header", True).option("escape", '"').csv(path)

    path = fixtures.made_once(spark, sf_dir, "csv-lines", make)
    return read_delimited(spark, path, schema, multi_line=True, split=True)


def stored_records(spark, sf_dir, first=None) -> DataFrame:
    return read_page_files(spark, fixtures.page_files(spark, sf_dir), RAW, first)


@query
def src_page_files(spark, sf_dir):
    return stored_records(spark, sf_dir)


@query
def src_landing_table(spark, sf_dir):
    path = fixtures.made_once(
        spark, sf_dir, "landing", lambda p: write_table(facts(spark, sf_dir), p)
    )
    return read_landing(spark, path)


@query
def src_clean_table(spark, sf_dir):
    path = fixtures.made_once(
        spark, sf_dir, "clean", lambda p: write_table(cleaning.clean(facts(spark, sf_dir)), p)
    )
    return read_clean(spark, path)


@query
def src_csv(spark, sf_dir):
    schema = fields(cod_depto="long", departamento="string", saldo="double")

    def make(path):
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("cod_depto"),
            F.concat(F.lit('"'), "c_name", F.lit('", '), "c_mktsegment").alias("departamento"),
            F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")).alias("saldo"),
        ).write.option("header", True).option("escape", '"').csv(path)

    return read_delimited(spark, fixtures.made_once(spark, sf_dir, "csv", make), schema)


PART_FIELDS = fields(cod_depto="long", categoria="string", num_municipios="integer")


def _part_arrays(spark, sf_dir) -> str:
    def make(path):
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("cod_depto"),
            F.when(F.col("p_partkey") % 9 != 0, F.col("p_brand")).alias("categoria"),
            F.col("p_size").alias("num_municipios"),
        )
        fixtures.write_json_arrays(part, F.floor(F.col("cod_depto") / fixtures.PAGE_SIZE), path)

    return fixtures.made_once(spark, sf_dir, "json", make)


@query
def src_json_array(spark, sf_dir):
    return read_json_array(spark, _part_arrays(spark, sf_dir), PART_FIELDS)


@query
def src_json_array_split(spark, sf_dir):
    return read_json_array(spark, _part_arrays(spark, sf_dir), PART_FIELDS, split=True)


@query
def src_pipe_text(spark, sf_dir):
    schema = fields(cod_depto="long", region="string", total="double")

    def make(path):
        table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("cod_depto"),
            F.concat("o_orderpriority", F.lit(", "), "o_orderstatus").alias("region"),
            F.col("o_totalprice").alias("total"),
        ).write.option("header", True).option("sep", "|").csv(path)

    path = fixtures.made_once(spark, sf_dir, "pipe", make)
    return read_delimited(spark, path, schema, sep="|")


CUSTOMER_FIELDS = fields(cod_depto="long", nombre="string", pib_total="long")


def _customer_xml(spark, sf_dir) -> str:
    def make(path):
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("cod_depto"),
            F.concat("c_name", F.lit(" <&> "), "c_mktsegment").alias("nombre"),
            F.floor(F.col("c_acctbal") * 100).alias("pib_total"),
        ).write.option("rootTag", "departamentos").option("rowTag", "departamento").xml(path)

    return fixtures.made_once(spark, sf_dir, "xml", make)


@query
def src_xml(spark, sf_dir):
    path = _customer_xml(spark, sf_dir)
    return read_xml_rows(spark, path, CUSTOMER_FIELDS, "departamento")


@query
def src_xml_split(spark, sf_dir):
    path = _customer_xml(spark, sf_dir)
    return read_xml_rows(spark, path, CUSTOMER_FIELDS, "departamento", split=True)


@query
def src_html_table(spark, sf_dir):
    """Whole raw pages, each with a table of one to five rows put before its last tag."""
    page = F.col("page_id")

    def row(i):
        name = F.concat(F.lit("<b>Nari&ntilde;o &amp; "), i.cast("string"), F.lit("</b>"))
        return fixtures.row_markup(page * 10 + i, name, F.format_number(page * 1000 + i, 0))

    body = F.array_join(F.transform(F.sequence(F.lit(0), page % 5), row), "")
    markup = fixtures.table_markup(["cod_depto", "nombre", "poblacion_ocupada"], body)
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.concat("html", markup, F.lit("</html>")).alias("html")
    )
    schema = fields(cod_depto="integer", nombre="string", poblacion_ocupada="long")
    return html_table(pages, schema)


@query
def src_html_spans(spark, sf_dir):
    """Whole raw pages, each with a table whose first column spans rows and whose last row spans columns."""
    page = F.col("page_id")
    height = (page % 4 + 1).cast("string")

    def row(i):
        first = F.when(i == 0, F.concat(F.lit('<td rowspan="'), height, F.lit('">'), page.cast("string"), F.lit("</td>")))
        cells = F.concat(F.lit("<td>"), i.cast("string"), F.lit("</td><td>"), (page + i).cast("string"), F.lit("</td>"))
        return F.concat(F.lit("<tr>"), F.coalesce(first, F.lit("")), cells, F.lit("</tr>"))

    body = F.array_join(F.transform(F.sequence(F.lit(0), page % 4), row), "")
    last = F.concat(F.lit("<tr><td>-1</td><td colspan='2'>"), page.cast("string"), F.lit("</td></tr>"))
    markup = fixtures.table_markup(["grupo", "n", "total"], F.concat(body, last))
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat("html", markup, F.lit("</html>")).alias("html"))
    return html_table(pages, fields(grupo="long", n="long", total="long"), spans=True)


@query
def src_local_rows(spark, sf_dir):
    """Local rows, the texts for event types, against counts from the events."""
    labels = spark.createDataFrame(
        [("click", "Clic"), ("view", "Vista"), ("purchase", "Compra"), ("signup", "Registro")],
        "event_type string, label string",
    )
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events")
    )
    return counts.join(labels, "event_type", "left")


# --- sinks -------------------------------------------------------------------


@query
def sink_landing_overwrite(spark, sf_dir):
    path = shared_dir(spark)
    write_table(land(facts(spark, sf_dir).withColumn("departamento", F.lit("old"))), path)
    write_table(land(facts(spark, sf_dir)), path)
    return read_landing(spark, path)


@query
def sink_versions(spark, sf_dir):
    """The current version of a table after two refreshes and one that failed."""
    path = shared_dir(spark)
    commit_table(land(facts(spark, sf_dir).withColumn("departamento", F.lit("old"))), path)
    commit_table(land(facts(spark, sf_dir)), path)
    lost = F.raise_error(F.lit("ended half-way")).cast("string")
    try:
        commit_table(land(facts(spark, sf_dir).withColumn("departamento", lost)), path)
    except Exception as error:  # noqa: BLE001
        if "ended half-way" not in str(error):
            raise
    return read_landing(spark, path)


@query
def surrogate_id(spark, sf_dir):
    return fixtures.numbered_records(spark, sf_dir)


@query
def surrogate_id_indexed(spark, sf_dir):
    """The same ids by an index of the keys: no whole row is written."""
    source = facts(spark, sf_dir).withColumnRenamed("id", "source_id")
    return paging.number_rows(source, paging.index_keys(source, ("fecha_hecho", "source_id")))


@query
def sample_raw(spark, sf_dir):
    """First records as exported, read back from the file; all fields of a record."""
    schema = StructType([*RAW.fields, StructField("source_id", StringType())])
    path = fixtures.page_files(spark, sf_dir)
    first = read_pages(
        spark, schema, StoredPages, path=path, limit=str(fixtures.PAGE_SIZE), first="1000"
    )
    out = shared_dir(spark)
    write_sample(ordering.sample(first), out)
    # With a NULL text that no field holds, a quoted empty field is read as a text.
    options = {"header": True, "escape": '"', "nullValue": "\0", "multiLine": True}
    return spark.read.schema(schema).options(**options).csv(out)


@query
def sample_clean(spark, sf_dir):
    return ordering.sample_as_text(written(cleaning.clean(facts(spark, sf_dir)), shared_dir(spark)))


@query
def sample_enriched(spark, sf_dir):
    clean = cleaning.clean(facts(spark, sf_dir))
    enriched = enrichment.enrich(clean, dimensions(spark, sf_dir))
    return ordering.sample_as_text(written(enriched, shared_dir(spark)))


@query
def sink_report_text(spark, sf_dir):
    """A report file read back as one text, so that line order counts."""
    out = shared_dir(spark)
    lines = ingest_lines(spark, sf_dir)
    write_report(lines, out)
    return spark.read.text(out, wholetext=True).withColumnRenamed("value", "content")


@query
def sink_clean_table(spark, sf_dir):
    path = shared_dir(spark)
    write_table(cleaning.clean(facts(spark, sf_dir)), path)
    return read_clean(spark, path)


# --- projections and filters -------------------------------------------------


@query
def proj_fixed_fields(spark, sf_dir):
    """JSON records with absent and extra fields to the fixed fields."""
    record = F.to_json(
        F.struct("fecha_hecho", "cod_depto", "departamento", "municipio", "cantidad",
                 F.lit(1).alias("otro"))
    )
    records = facts(spark, sf_dir).select("id", record.alias("json"))
    return land(records_from_json(records, "json"))


@query
def proj_dim_columns(spark, sf_dir):
    """Key and kept columns of a dimension as big as the customers."""
    customers = table(spark, sf_dir, "customer")
    return project_fields(
        customers.withColumnRenamed("c_custkey", "cod_depto"),
        fields(cod_depto="long", c_acctbal="double", poblacion_2023="long"),
    )


@query
def proj_all_but_id(spark, sf_dir):
    df = facts(spark, sf_dir)
    return df.select(*dedup.key_columns(df))


@query
def proj_replace_columns(spark, sf_dir):
    return cleaning.normalise(facts(spark, sf_dir))


@query
def proj_derived_rate(spark, sf_dir):
    clean = cleaning.clean(facts(spark, sf_dir))
    joined = enrichment.join_dimensions(
        enrichment.with_key(clean), dimensions(spark, sf_dir)[:1]
    )
    return enrichment.with_rate(joined)


@query
def filter_valid_date(spark, sf_dir):
    return cleaning.drop_undated(facts(spark, sf_dir))


@query
def filter_not_null(spark, sf_dir):
    df = facts(spark, sf_dir)
    counts = [F.count(c).alias(f"with_{c}") for c in df.columns]
    return to_metrics(df.agg(*counts))


# --- joins -------------------------------------------------------------------


@query
def join_left_dim(spark, sf_dir):
    keyed = enrichment.with_key(facts(spark, sf_dir))
    return enrichment.join_dimensions(keyed, dimensions(spark, sf_dir)[:1])


@query
def join_left_chain5(spark, sf_dir):
    keyed = enrichment.with_key(facts(spark, sf_dir))
    return enrichment.join_dimensions(keyed, dimensions(spark, sf_dir))


@query
def join_left_shuffled(spark, sf_dir):
    """The same five joins as if no dimension could be broadcast and most keys were hot."""
    keyed = enrichment.with_key(facts(spark, sf_dir))
    return enrichment.join_dimensions(
        keyed, dimensions(spark, sf_dir), broadcast_bytes=0, rows_per_task=100
    )


@query
def join_left_reduced(spark, sf_dir):
    """The same as if no dimension could be broadcast but its keys could: unmatched facts stay."""
    keyed = enrichment.with_key(facts(spark, sf_dir))
    return enrichment.join_dimensions(
        keyed, dimensions(spark, sf_dir), broadcast_bytes=0, rows_per_task=100, key_bytes=1 << 20
    )


@query
def join_left_stored(spark, sf_dir):
    """The same from facts and dimensions written in buckets of the key, most keys hot."""
    keyed = enrichment.with_key(facts(spark, sf_dir))
    root = shared_dir(spark)
    name = root.rpartition("/")[2].replace("-", "_")
    kept = stored.store_facts(keyed, f"{name}_facts", f"{root}/facts", buckets=8, rows_per_task=100)
    dims = [
        stored.store_dimension(d, kept, f"{name}_{i}", f"{root}/dimension-{i}")
        for i, d in enumerate(dimensions(spark, sf_dir))
    ]
    return stored.join_stored(kept, dims)


@query
def join_left_pruned(spark, sf_dir):
    """One column of the five joins: only its dimension is joined."""
    keyed = enrichment.with_key(facts(spark, sf_dir))
    view = enrichment.join_dimensions(keyed, dimensions(spark, sf_dir), prunable=True)
    return view.select("id", KEY, "region")


@query
def join_key_coercion(spark, sf_dir):
    return enrichment.with_key(facts(spark, sf_dir)).select("id", KEY)


@query
def join_fanout_check(spark, sf_dir):
    """Five unique dimensions, and customers per nation as one with repeated keys."""
    customers = table(spark, sf_dir, "customer").select(
        (F.col("c_nationkey") + 1).alias(KEY), "c_name"
    )
    dims = [
        *dimensions(spark, sf_dir),
        enrichment.Dimension("repeated", customers, "c_name"),
    ]
    return enrichment.fanout_check(facts(spark, sf_dir), dims)


# --- aggregations ------------------------------------------------------------


@query
def agg_row_count(spark, sf_dir):
    return facts(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"))


@query
def agg_null_profile(spark, sf_dir):
    return cleaning.null_profile(facts(spark, sf_dir))


@query
def agg_duplicate_count(spark, sf_dir):
    return dedup.duplicate_count(facts(spark, sf_dir))


@query
def agg_dedup_subset(spark, sf_dir):
    return dedup.deduplicate(facts(spark, sf_dir))


@query
def agg_step_removed(spark, sf_dir):
    return cleaning.step_counts(facts(spark, sf_dir))


@query
def agg_reconcile(spark, sf_dir):
    """Page records against a landing table that lacks those without a department."""
    stored = facts(spark, sf_dir).filter(F.col("departamento").isNotNull())
    return reconcile(stored_records(spark, sf_dir), stored)


@query
def agg_unreadable_counts(spark, sf_dir):
    """Counts that are no number, among records where some hold a word instead."""
    word = F.when(F.col("id") % 3 == 0, F.trim("municipio")).otherwise(
        F.col("cantidad").cast("string")
    )
    return facts(spark, sf_dir).withColumn("cantidad", word).agg(
        unreadable_counts().alias("unreadable_counts")
    )


@query
def agg_match_counts(spark, sf_dir):
    clean = cleaning.clean(facts(spark, sf_dir))
    return enrichment.match_counts(clean, dimensions(spark, sf_dir))


@query
def agg_source_counts(spark, sf_dir):
    """Rows, keys and bytes per source; the last source is as big as the customers."""
    customers = table(spark, sf_dir, "customer").select(
        (F.col("c_nationkey") + 1).alias(KEY), "c_name"
    )
    dims = [
        *dimensions(spark, sf_dir),
        enrichment.Dimension("clientes", customers, "c_name"),
    ]
    return enrichment.dimension_sizes(dims)


@query
def agg_clean_summary(spark, sf_dir):
    return cleaning.clean_summary(facts(spark, sf_dir))


@query
def agg_schema_delta(spark, sf_dir):
    clean = cleaning.clean(facts(spark, sf_dir))
    return enrichment.schema_delta(clean, enrichment.enrich(clean, dimensions(spark, sf_dir)))


# --- order, limit, union -----------------------------------------------------


@query
def sort_by_event_date(spark, sf_dir):
    return ordering.by_event_time(facts(spark, sf_dir))


@query
def limit_sample(spark, sf_dir):
    return ordering.sample(facts(spark, sf_dir))


@query
def limit_offset_page(spark, sf_dir):
    return ordering.page_slice(facts(spark, sf_dir), offset=1500, limit=500)


@query
def limit_deep_page(spark, sf_dir):
    """The same page; there is one way for all depths."""
    return ordering.page_slice(facts(spark, sf_dir), offset=1500, limit=500)


@query
def limit_page_by_id(spark, sf_dir):
    return ordering.page_by_id(fixtures.numbered_records(spark, sf_dir), offset=1500, limit=500)


@query
def limit_indexed_pages(spark, sf_dir):
    """A page of 100 rows at each tenth of the event order, all by one index, which is opened anew."""
    df, order, path = facts(spark, sf_dir), ("fecha_hecho", "id"), shared_dir(spark)
    paging.index_keys(df, order, path, block_rows=1000)
    index, rows = paging.open_index(spark, path, order), df.count()
    pages = [paging.page(df, index, rows * i // 10, 100).withColumn("page", F.lit(i)) for i in range(10)]
    return ordering.append_pages(pages)


@query
def union_pages(spark, sf_dir):
    """Facts appended to themselves without a column, duplicates kept."""
    df = facts(spark, sf_dir)
    return ordering.append_pages([df, df.drop("municipio")])


# --- scalar functions --------------------------------------------------------


@query
def fn_parse_timestamp(spark, sf_dir):
    text = F.when(F.col("id") % 29 == 0, F.concat("fecha_hecho", F.lit("x"))).otherwise(
        F.col("fecha_hecho")
    )
    return facts(spark, sf_dir).select("id", parse_event_time(text).alias("parsed"))


@query
def fn_count_to_int(spark, sf_dir):
    return facts(spark, sf_dir).select(
        "id", to_count(F.col("cantidad") - 50).alias("signed_count"),
        to_count(F.col("cantidad") * 1e18).alias("large_count"),
    )


@query
def fn_code_to_string(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        to_code(F.col("l_partkey")).alias("part_code"),
        to_code(F.col("l_linenumber")).alias("line_code"),
        to_code(F.concat(F.lit("  "), "l_returnflag", F.lit(" "))).alias("flag_code"),
    )


@query
def fn_trim(spark, sf_dir):
    return facts(spark, sf_dir).select(
        "id",
        F.trim("departamento").alias("name"),
        F.trim(F.concat(F.lit("\t "), "municipio", F.lit("\t"))).alias("tabbed"),
    )


@query
def fn_upper_trim(spark, sf_dir):
    return facts(spark, sf_dir).select(
        "id",
        to_name(F.col("departamento")).alias("departamento"),
        to_name(F.concat(F.lit(" ñandú "), "municipio")).alias("municipio"),
    )


@query
def fn_key_to_int(spark, sf_dir):
    return facts(spark, sf_dir).select(
        "id",
        to_key(F.col("cod_depto")).alias("key"),
        to_key(F.col("cod_muni")).alias("town_key"),
        to_key(F.col("municipio")).alias("no_key"),
    )


@query
def fn_fill_text(spark, sf_dir):
    texts = {k: v for k, v in FILL_VALUES.items() if isinstance(v, str)}
    return facts(spark, sf_dir).fillna(texts)


@query
def fn_fill_number(spark, sf_dir):
    return facts(spark, sf_dir).fillna({"cantidad": FILL_VALUES["cantidad"]})


@query
def fn_safe_ratio(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        safe_ratio(F.col("l_extendedprice"), F.col("l_partkey") % 7).alias("ratio"),
    )


@query
def fn_rate_per_100k(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        rate_per_100k(F.col("l_quantity"), F.col("l_partkey") * F.col("l_suppkey")).alias("rate"),
    )


@query
def fn_round4(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") / 7, 4).alias("rounded")
    )


@query
def fn_timestamp_text(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", timestamp_text(F.col("ts")).alias("text")
    )


@query
def fn_report_line(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", count_line(F.col("event_type"), F.col("user_id")).alias("line")
    )


@query
def fn_run_timestamp(spark, sf_dir):
    """A report title for each event, as if it were the time of a run."""
    return table(spark, sf_dir, "events").select(
        "event_id", reports.title_line(reports.CLEAN_TITLE, F.col("ts")).alias("line")
    )


# --- jobs and reports --------------------------------------------------------

SOURCE_LABEL = "events"


def ingest_lines(spark, sf_dir) -> DataFrame:
    landing = src_landing_table(spark, sf_dir)
    counts = reconcile(stored_records(spark, sf_dir), landing)
    return reports.ingest_report(counts, run_time(), SOURCE_LABEL)


@query
def report_ingest(spark, sf_dir):
    return ingest_lines(spark, sf_dir)


@query
def report_clean(spark, sf_dir):
    landing = facts(spark, sf_dir)
    audit = cleaning.clean_audit(landing)
    return reports.clean_report(audit, landing, run_time(), SOURCE_LABEL)


@query
def report_enrich(spark, sf_dir):
    clean = cleaning.clean(facts(spark, sf_dir))
    dims = dimensions(spark, sf_dir)
    sizes = enrichment.measure(dims)
    rows = metrics_frame(spark, {f"rows_{name}": size.rows for name, size in sizes.items()})
    audit = enrichment.match_counts(clean, dims, sizes).unionByName(rows)
    return reports.enrich_report(audit, clean.columns, dims, run_time(), 1000)


@query
def job_profile(spark, sf_dir):
    return cleaning.profile(facts(spark, sf_dir))


@query
def job_clean(spark, sf_dir):
    return cleaning.clean(facts(spark, sf_dir))


@query
def job_enrich(spark, sf_dir):
    clean = cleaning.clean(facts(spark, sf_dir))
    return enrichment.enrich(clean, dimensions(spark, sf_dir))


@query
def job_ingest(spark, sf_dir):
    """Pages to landing table, sample and report; the landing table read back."""
    raw = raw_records(spark, sf_dir)
    first = raw_records(spark, sf_dir, first="1000")
    return run_ingest(raw, shared_dir(spark), run_time(), SOURCE_LABEL, first).table


@query
def job_clean_written(spark, sf_dir):
    """The cleaning job with its audit taken by the write; the audit figures."""
    landing = src_landing_table(spark, sf_dir)
    result = run_clean(landing, shared_dir(spark), run_time(), SOURCE_LABEL)
    return metrics_frame(spark, result.metrics)


@query
def job_ingest_written(spark, sf_dir):
    """The figures that the ingest job takes while it writes."""
    raw, first = raw_records(spark, sf_dir), raw_records(spark, sf_dir, first="1000")
    result = run_ingest(raw, shared_dir(spark), run_time(), SOURCE_LABEL, first)
    return metrics_frame(spark, result.metrics)


@query
def job_enrich_written(spark, sf_dir):
    """The figures that the enrichment job takes while it writes."""
    clean, dims = src_clean_table(spark, sf_dir), dimensions(spark, sf_dir)
    result = run_enrich(clean, dims, shared_dir(spark), run_time())
    return metrics_frame(spark, result.metrics)


@query
def job_end_to_end(spark, sf_dir):
    """All three stages from page files to the enriched table, read back."""
    raw, first = stored_records(spark, sf_dir), stored_records(spark, sf_dir, first=1000)
    dims = dimensions(spark, sf_dir)
    return run_all(raw, dims, shared_dir(spark), run_time(), SOURCE_LABEL, first)[-1].table
