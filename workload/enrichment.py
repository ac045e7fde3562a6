"""Annotation payloads, score tracks, assembly maps, outside scores and grids, derived by Spark from the tables.

Stand-ins: a customer is a chromosome and a day a position; orders make the score tracks and the assembly blocks,
shipped line items the points. The tracks overlap, so "first hit" is put to the test.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions import payload
from tamarack.operators import enrich, grid, intervals
from tamarack.session import written
from tamarack.sources import payloads
from workload.catalog import Tables, query


def _annotations(t: Tables) -> DataFrame:
    """One JSON payload per event, landed as text and read with its schema. Some have no transcripts, some no frequencies, some both kinds of frequency."""
    kind, value = F.col("event_type"), F.col("value").cast("string")
    transcripts = F.when(kind == "click", F.lit("[]")).when(kind == "view", F.lit("null")).otherwise(
        F.concat(F.lit('[{"impact": "'), F.upper(kind), F.lit('"}, {"impact": "OTHER"}]'))
    )
    exome = F.when(F.col("value") > 20, F.concat(F.lit('"gnomade": '), value, F.lit(", "))).otherwise(F.lit(""))
    genome = F.concat(F.lit('"gnomadg": '), F.get_json_object("props", "$.k"))
    found = F.concat(
        F.lit('[{"id": "rs1"}, {"frequencies": {"C": {"af": 0.5}}}, {"frequencies": {"T": {'), exome, genome,
        F.lit('}, "A": {"gnomade": 0.125}}}]'),
    )
    colocated = F.when(kind == "error", F.lit("null")).otherwise(found)
    json = F.concat(
        F.lit('{"input": "7 '), F.col("user_id").cast("string"), F.lit(' . A T . . .", "most_severe_consequence": "'), kind,
        F.lit('_variant", "src_ord": '), F.col("event_id").cast("string"), F.lit(', "transcript_consequences": '), transcripts, F.lit(', "colocated_variants": '), colocated, F.lit("}"),
    )
    return payloads.annotation_payloads(t.spark, t.land(t.events.select(json.alias("value")), "annotations"))


ANNOTATION_SQL = """
with ann as (
    select event_id, user_id, event_type || '_variant' as most_severe_consequence,
        case when event_type not in ('click', 'view') then upper(event_type) end as vep_impact,
        case when event_type = 'error' then null when value > 20 then value
            else cast(json_extract_string(props, '$.k') as double) end as gnomad_af
    from events)
"""


@query(ANNOTATION_SQL + "select event_id, most_severe_consequence, vep_impact, gnomad_af from ann")
def annotation_fields(t: Tables) -> DataFrame:
    return _annotations(t).select(
        F.col("src_ord").alias("event_id"), "most_severe_consequence",
        payload.first_impact(F.col("transcript_consequences")).alias("vep_impact"),
        payload.first_frequency(F.col("colocated_variants")).alias("gnomad_af"),
    )


def _customers_as_variants(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", F.lit("chr7").alias("Chromosome"), F.col("c_custkey").cast("string").alias("Start"),
        F.lit(None).cast("string").alias("rsid_norm"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("")).otherwise(F.lit("A")).alias("ReferenceAlleleVCF"),
        F.lit("T").alias("AlternateAlleleVCF"),
    )


@query(ANNOTATION_SQL + """
, last as (select * from ann qualify row_number() over (partition by user_id order by event_id desc) = 1)
select c_custkey, '7 ' || c_custkey || ' . A T . . .' as region_string, most_severe_consequence, vep_impact, gnomad_af
from customer left join last on user_id = c_custkey where c_mktsegment <> 'MACHINERY'
""")
def annotated_rows(t: Tables) -> DataFrame:
    annotated, _ = enrich.annotate(_customers_as_variants(t), _annotations(t))
    return annotated.select("c_custkey", "region_string", "most_severe_consequence", "vep_impact", "gnomad_af")


@query("select c_custkey from customer where c_mktsegment = 'MACHINERY'")
def missing_alleles(t: Tables) -> DataFrame:
    _, aside = enrich.annotate(_customers_as_variants(t), _annotations(t))
    return aside.select("c_custkey")


def _day(column: str):
    return F.unix_date(F.to_date(column)).cast("bigint")


def _points(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("chrom"))
    return t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "chrom", _day("l_shipdate").alias("position"), "l_quantity"
    )


def _near_track(t: Tables) -> DataFrame:
    start = _day("o_orderdate")
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("chrom"), start.alias("start0"),
        (start + 10 + F.floor(F.col("o_totalprice") / 5000)).alias("end0"), F.col("o_totalprice").alias("value"),
    )


def _blocks(t: Tables) -> DataFrame:
    start, length = _day("o_orderdate"), F.floor(F.col("o_totalprice") / 4000).cast("bigint")
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("chrom"), start.alias("src_start"), (start + length).alias("src_end"),
        F.concat(F.lit("L"), F.col("o_custkey").cast("string")).alias("dst_chrom"), (start + 1000).alias("dst_start"),
        (start + length + 1000).alias("dst_end"), F.when(F.col("o_orderstatus") == "F", -1).otherwise(1).alias("strand"),
        F.col("o_orderkey").alias("ord"),
    )


def _far_track(t: Tables) -> DataFrame:
    start = _day("o_orderdate") + 1000
    return t.orders.select(
        F.concat(F.lit("L"), F.col("o_custkey").cast("string")).alias("chrom"), start.alias("start0"), (start + 40).alias("end0"),
        F.col("o_orderkey").cast("double").alias("value"),
    )


POSITION_SQL = """
with points as (
    select o_custkey as chrom, date_diff('day', date '1970-01-01', l_shipdate::date) as position, l_quantity
    from lineitem join orders on l_orderkey = o_orderkey),
spots as (select distinct chrom, position from points),
src as (select *, date_diff('day', date '1970-01-01', o_orderdate::date) as start0 from orders),
near_hit as (
    select s.chrom, s.position, o_totalprice as near_score from spots s join src o on o.o_custkey = s.chrom
        and s.position - 1 >= start0 and s.position - 1 < start0 + 10 + cast(floor(o_totalprice / 5000) as bigint)
    qualify row_number() over (partition by s.chrom, s.position
        order by start0, start0 + 10 + cast(floor(o_totalprice / 5000) as bigint), o_totalprice) = 1),
lift as (
    select s.chrom, s.position, 'L' || o_custkey as to_chrom,
        case when o_orderstatus = 'F' then start0 + cast(floor(o_totalprice / 4000) as bigint) + 1000 - (s.position - start0)
            else s.position + 1000 end as to_start
    from spots s join src o on o.o_custkey = s.chrom
        and s.position >= start0 and s.position <= start0 + cast(floor(o_totalprice / 4000) as bigint)
    qualify row_number() over (partition by s.chrom, s.position order by o_orderkey) = 1),
far_hit as (
    select l.chrom, l.position, cast(o_orderkey as double) as far_score from lift l join src o on o.o_custkey = l.chrom
        and l.to_start - 1 >= start0 + 1000 and l.to_start - 1 < start0 + 1040
    qualify row_number() over (partition by l.chrom, l.position order by start0, o_orderkey) = 1)
"""


@query(POSITION_SQL + """
select p.chrom::varchar as chrom, count(*) as n, count(near_score) as n_hit, cast(sum(cast(near_score as decimal(18, 2))) as double) as total
from points p left join near_hit using (chrom, position) group by 1
""")
def score_lookup(t: Tables) -> DataFrame:
    """The track is read back from text."""
    track = payloads.score_track(t.spark, t.land(_near_track(t), "near.bedgraph", "csv", sep="\t"))
    scored = intervals.with_scores(_points(t), track, "chrom", "position", "near_score")
    return scored.groupBy("chrom").agg(
        F.count(F.lit(1)).alias("n"), F.count("near_score").alias("n_hit"),
        F.sum(F.col("near_score").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(POSITION_SQL + """
select p.chrom::varchar as chrom, to_chrom, count(*) as n, cast(sum(to_start) as bigint) as starts, cast(sum(to_start) as bigint) as ends
from points p left join lift using (chrom, position) group by 1, 2
""")
def liftover(t: Tables) -> DataFrame:
    """The map is read back from text."""
    blocks = payloads.assembly_map(t.spark, t.land(_blocks(t), "map.tsv", "csv", sep="\t"))
    mapped = intervals.with_liftover(_points(t), blocks, "chrom", "position", "to")
    return mapped.groupBy("chrom", "to_chrom").agg(
        F.count(F.lit(1)).alias("n"), F.sum("to_start").alias("starts"), F.sum("to_end").alias("ends")
    )


@query(POSITION_SQL + """
select p.chrom::varchar as chrom, count(*) as n, count(near_score) as n_near, count(to_start) as n_lifted, count(far_score) as n_far,
    cast(sum(cast(far_score as bigint)) as bigint) as far_total, count(*) - count(near_score + far_score) as n_incomplete
from points p left join near_hit using (chrom, position) left join lift using (chrom, position) left join far_hit using (chrom, position)
group by 1
""")
def chained_scores(t: Tables) -> DataFrame:
    """Near score, lifted position, and far score at the lifted position."""
    scored = intervals.conservation(_points(t), "chrom", "position", _near_track(t), _blocks(t), _far_track(t))
    incomplete = F.col("phylop100way").isNull() | F.col("gerp_score").isNull()
    return scored.groupBy("chrom").agg(
        F.count(F.lit(1)).alias("n"), F.count("phylop100way").alias("n_near"), F.count("hg19_start").alias("n_lifted"),
        F.count("gerp_score").alias("n_far"), F.sum(F.col("gerp_score").cast("bigint")).alias("far_total"),
        F.count_if(incomplete).alias("n_incomplete"),
    )


@query("""
select p_partkey, 'chr' || p_size || ':g.' || p_partkey || 'A>' || p_type[1] as hgvs, true as is_snv,
    case when p_size > 40 or p_brand = 'Brand#1' then null else p_retailprice end as revel_score,
    case when p_size > 40 or p_type = 'SMALL' then null when p_type = 'ECONOMY' then p_size + 0.5 else p_retailprice + 1 end as cadd_phred
from part
""")
def external_scores(t: Tables) -> DataFrame:
    """Scores come as numbers, lists, an empty list, or not at all; some only at the top level. Read back from JSON lines."""
    key = F.concat(
        F.lit("chr"), F.col("p_size").cast("string"), F.lit(":g."), F.col("p_partkey").cast("string"), F.lit("A>"), F.substring("p_type", 1, 1)
    )
    price = F.col("p_retailprice").cast("string")
    revel = F.when(F.col("p_brand") == "Brand#1", F.lit('"n/a"')).otherwise(F.concat(F.lit('{"score": ['), price, F.lit(", 0.5]}")))
    nested = F.when(F.col("p_type") == "SMALL", F.lit('{"phred": []}')).when(
        F.col("p_type") == "ECONOMY", F.lit("null")
    ).otherwise(F.concat(F.lit('{"phred": '), (F.col("p_retailprice") + 1).cast("string"), F.lit("}")))
    json = F.concat(
        F.lit('{"query": "'), key, F.lit('", "dbnsfp": {"revel": '), revel, F.lit(', "cadd": '), nested, F.lit('}, "cadd": {"phred": '),
        (F.col("p_size") + F.lit(0.5)).cast("string"), F.lit("}}"),
    )
    landed = payloads.score_payloads(t.spark, t.land(t.part.filter("p_size <= 40").select(json.alias("value")), "scores"))
    rows = t.part.select(
        "p_partkey", F.col("p_size").cast("string").alias("Chromosome"), F.col("p_partkey").cast("string").alias("Start"),
        F.lit("A").alias("ReferenceAlleleVCF"), F.substring("p_type", 1, 1).alias("AlternateAlleleVCF"),
    )
    scored = enrich.with_external_scores(rows, landed, "query", "json")
    return scored.select("p_partkey", "hgvs", "is_snv", "revel_score", "cadd_phred")


BLOCK = 100  # customers per grid


def _cells(t: Tables) -> DataFrame:
    """One grid per hundred customers: a row per customer, a column per order year, totals of the year as values.

    Each grid has a title, two rsid rows, a column with "effect" above the header, and blank customer names.
    """
    gene = F.concat(F.lit("G"), F.floor(F.col("c_custkey") / BLOCK).cast("string"))
    row = (F.col("c_custkey") % BLOCK + 6).cast("int")
    rows = t.customer.select(gene.alias("gene"), row.alias("row_idx"), "c_custkey", "c_acctbal", "c_name")
    names = rows.select("gene", "row_idx", F.lit(0).alias("col_idx"), F.when(F.col("c_acctbal") < -900, F.lit("  ")).otherwise(
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" "))).alias("value"))
    spent = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("string").alias("value")
    )
    values = rows.join(spent, "c_custkey").select("gene", "row_idx", (F.col("year") - 1990).alias("col_idx"), "value")
    grids = rows.select("gene").distinct()
    titles = F.array(*[F.struct(F.lit(i).alias("row_idx"), F.lit(text).alias("value")) for i, text in [
        (0, "Title"), (1, "Label"), (2, "rsID"), (3, "Effect on allele"), (4, " RSID "), (5, "Name of Allele"),
    ]])
    marks = grids.select("gene", F.inline(titles)).select("gene", "row_idx", F.lit(0).alias("col_idx"), "value")
    years = spent.select("year").distinct()
    heads = F.array(
        F.struct(F.lit(1).alias("row_idx"), F.concat(F.lit("y"), F.col("year").cast("string")).alias("value")),
        F.struct(F.lit(2).alias("row_idx"), F.lit("wrong").alias("value")),
        F.struct(F.lit(4).alias("row_idx"), F.when(F.col("year") != 1995, F.concat(F.lit("rs"), F.col("year").cast("string"))).alias("value")),
    )
    used = values.select("gene", F.col("col_idx")).distinct()
    header = used.join(years.withColumn("col_idx", F.col("year") - 1990), "col_idx").select(
        "gene", "col_idx", F.inline(heads)
    ).select("gene", "row_idx", "col_idx", "value")
    return written(names.unionByName(values).unionByName(marks).unionByName(header), "cells")


@query(f"""
with named as (select c_custkey, c_custkey // {BLOCK} as g, trim(c_name) as name, c_acctbal < -900 as blank from customer),
stop as (select g, min(c_custkey) as stop from named where blank group by 1),
kept as (select n.* from named n left join stop s using (g) where s.stop is null or c_custkey < s.stop)
select 'G' || g as gene, name as allele_name, 'y' || year(o_orderdate) as variant_label,
    case when year(o_orderdate) <> 1995 then 'rs' || year(o_orderdate) end as rsid,
    cast(sum(cast(o_totalprice as decimal(18, 2))) as varchar) as allele_nt_value
from kept join orders on o_custkey = c_custkey group by g, name, year(o_orderdate)
""")
def grid_to_pairs(t: Tables) -> DataFrame:
    return grid.allele_variants(_cells(t)).drop("src_ord")


@query(f"select distinct 'G' || (c_custkey // {BLOCK}) as gene, 4 as rsid_row, 5 as header_row from customer")
def grid_headers(t: Tables) -> DataFrame:
    return grid.header_rows(_cells(t))
