"""Scans, predicates, label reconciliation and the gold build, on orders and line items.

Stand-ins: a customer is a gene, the order year a variant, the order priority a label of which one is unusable.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions import text
from tamarack.functions.vocab import USABLE_TERMS
from tamarack.operators import enrich, features, filters, keys, summaries
from tamarack.operators.scoring import display_columns
from tamarack.sources import payloads, tables
from workload.catalog import Tables, query

PANEL = ["Brand#1", "Brand#2", "Brand#3", "Brand#5", "Brand#8", "Brand#13", "Brand#21"]
USABLE = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PANEL_SQL = ", ".join(f"'{b}'" for b in PANEL)
USABLE_SQL = ", ".join(f"'{p}'" for p in USABLE)


@query(f"""
select count(*) as n_rows, count(distinct p_brand) as n_distinct
from lineitem join part on l_partkey = p_partkey
where p_brand in ({PANEL_SQL}) and l_linestatus = 'O'
""")
def panel_scan(t: Tables) -> DataFrame:
    parts = t.part.filter(filters.in_panel(F.col("p_brand"), PANEL)).select("p_partkey", "p_brand")
    rows = t.lineitem.filter("l_linestatus = 'O'").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return summaries.rows_and_distinct(rows, "p_brand")


@query("""
select o_orderpriority, count(*) as n from orders
where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING') group by 1
""")
def panel_as_table(t: Tables) -> DataFrame:
    panel = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return summaries.value_counts(filters.semi_panel(t.orders, panel, "o_custkey"), ["o_orderpriority"])


@query("""
select p_brand, count(*) as n from part
where coalesce(contains(nullif(p_name, 'red bolt'), 'ring') or contains(nullif(p_name, 'red bolt'), 'bolt'), false) group by 1
""")
def substring_panel(t: Tables) -> DataFrame:
    named = t.part.withColumn("p_name", F.nullif("p_name", F.lit("red bolt")))
    return summaries.value_counts(named.filter(filters.mentions_any(F.col("p_name"), ["ring", "bolt"])), ["p_brand"])


@query(f"""
select p_brand as "GeneSymbol", case when p_type <> 'SMALL' then p_name end as "Name", p_retailprice::varchar as "Start",
    p_partkey::varchar as "VariationID", 'GRCh38' as "Assembly"
from part where p_brand in ({PANEL_SQL}) and p_size % 2 = 0
""")
def text_variant_scan(t: Tables) -> DataFrame:
    """Compressed text with null tokens, unknown columns and rows of another assembly; known columns come back as text."""
    rows = t.part.select(
        F.col("p_size").alias("Other"), F.col("p_partkey").alias("VariationID"), F.col("p_brand").alias("GeneSymbol"),
        F.when(F.col("p_type") == "SMALL", F.lit("NA")).otherwise(F.col("p_name")).alias("Name"),
        F.when(F.col("p_size") % 2 == 0, F.lit("GRCh38")).otherwise(F.lit("GRCh37")).alias("Assembly"),
        F.col("p_retailprice").alias("Start"),
    )
    path = t.land(rows, "variants.txt.gz", "csv", sep="\t", header=True, compression="gzip", escape='"')
    return tables.variants(t.spark, path, PANEL, "GRCh38")


@query("""
select p_partkey::varchar as "Id", p_name as "Related Genes" from part
where p_name <> 'red bolt' and (contains(p_name, 'ring') or contains(p_name, 'bolt'))
""")
def text_bulk_scan(t: Tables) -> DataFrame:
    """A text table whose gene column is found by its name."""
    rows = t.part.select(F.col("p_partkey").alias("Id"), F.when(F.col("p_name") != "red bolt", F.col("p_name")).alias("Related Genes"))
    path = t.land(rows, "bulk.tsv", "csv", sep="\t", header=True, escape='"')
    return tables.bulk_table(t.spark, path, ["ring", "bolt"])


def _label_payloads(t: Tables) -> DataFrame:
    """A landed JSON payload per customer, read back from JSON lines; a negative balance names an accession of another segment."""
    accession = F.when(F.col("c_acctbal") < 0, F.lit("HOUSEHOLD")).otherwise(F.col("c_mktsegment"))
    term = F.when(F.col("c_acctbal") > 5000, F.lit('"Normal function"')).when(
        F.col("c_acctbal") > 1000, F.lit('"Uncertain function"')
    ).otherwise(F.lit("null"))
    json = F.concat(
        F.lit('{"accession": "PA-'), accession, F.lit('", "data": {"geneSymbol": "'), F.col("c_mktsegment"),
        F.lit('", "alleleType": null, "haplotypes": [{"name": "'), F.col("c_name"), F.lit('", "functionTerm": '), term,
        F.lit(', "pharmVarId": "'), F.col("c_nationkey").cast("string"),
        F.lit('"}, {"name": "*1", "functionTerm": "No function", "ampTier": "Tier 1"}]}}'),
    )
    return payloads.label_payloads(t.spark, t.land(t.customer.select(json.alias("value")), "labels"))


@query("""
with accepted as (select * from customer where not (c_acctbal < 0 and c_mktsegment <> 'HOUSEHOLD'))
select c_mktsegment as gene, 'PA-' || c_mktsegment as pa_id, c_name as allele_name,
    case when c_acctbal > 5000 then 'Normal function' when c_acctbal > 1000 then 'Uncertain function' end as function_term,
    cast(c_nationkey as varchar) as pharm_var_id, cast(null as varchar) as amp_tier, c_acctbal > 5000 as usable_label
from accepted
union all
select c_mktsegment, 'PA-' || c_mktsegment, '*1', 'No function', null, 'Tier 1', true from accepted
""")
def label_payload_rows(t: Tables) -> DataFrame:
    expected = {segment: f"PA-{segment}" for segment in SEGMENTS}
    accepted, _ = filters.payload_guard(_label_payloads(t), "accession", "data.geneSymbol", expected)
    return enrich.label_rows(accepted, USABLE_TERMS)


@query("""
select 'PA-HOUSEHOLD' as accession, c_mktsegment as gene_symbol, count(*) as n
from customer where c_acctbal < 0 and c_mktsegment <> 'HOUSEHOLD' group by 2
""")
def rejected_payloads(t: Tables) -> DataFrame:
    expected = {segment: f"PA-{segment}" for segment in SEGMENTS}
    _, rejected = filters.payload_guard(_label_payloads(t), "accession", "data.geneSymbol", expected)
    return summaries.value_counts(rejected.select("accession", F.col("data.geneSymbol").alias("gene_symbol")), ["accession", "gene_symbol"])


def crosswalk(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("gene"), F.year("o_orderdate").alias("rsid"), F.col("o_orderpriority").alias("function_term"),
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("allele_name"), F.col("o_orderkey").alias("src_ord"),
        filters.usable(F.col("o_orderpriority"), USABLE).alias("usable_label"),
    )


CROSSWALK_SQL = f"""
with cw as (
    select o_custkey as gene, year(o_orderdate) as rsid, o_orderpriority as function_term, 'O' || o_orderkey as allele_name,
        o_orderkey as src_ord, coalesce(o_orderpriority in ({USABLE_SQL}), false) as usable_label
    from orders)
"""


@query("""
select o_orderstatus, count(usable) as total, cast(sum(usable::int) as bigint) as usable,
    cast(count(usable) - sum(usable::int) as bigint) as excluded
from (select o_orderstatus, coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED') is not null, false) as usable from orders) group by 1
""")
def label_availability(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("usable_label", filters.usable(F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")), USABLE))
    return summaries.label_availability(rows, ["o_orderstatus"], "usable_label")


@query("select distinct o_orderstatus, nullif(o_orderpriority, '5-LOW') as term from orders")
def terms_seen(t: Tables) -> DataFrame:
    return summaries.terms_seen(t.orders.withColumn("term", F.nullif("o_orderpriority", F.lit("5-LOW"))), ["o_orderstatus"], "term")


@query("select p_type, count(*) as n from part where p_type is distinct from 'PROMO' group by 1")
def without_reference(t: Tables) -> DataFrame:
    return summaries.value_counts(t.part.filter(filters.not_reference(F.col("p_type"), "PROMO")), ["p_type"])


@query(CROSSWALK_SQL + "select gene, rsid, count(distinct function_term) as n_distinct_functions from cw group by 1, 2 having count(distinct function_term) > 1")
def ambiguous_keys_all_labels(t: Tables) -> DataFrame:
    return keys.conflicting_keys(crosswalk(t), ["gene", "rsid"], "function_term")


@query(CROSSWALK_SQL + "select gene, rsid, count(distinct function_term) as n_distinct_functions from cw where usable_label group by 1, 2 having count(distinct function_term) > 1")
def ambiguous_keys_usable_labels(t: Tables) -> DataFrame:
    return keys.conflicting_keys(crosswalk(t), ["gene", "rsid"], "function_term", "usable_label")


@query(CROSSWALK_SQL + """
, rows as (select nullif(gene, 7) as gene, rsid, function_term from cw where usable_label),
bad as (select gene, rsid from rows where gene is not null group by 1, 2 having count(distinct function_term) > 1)
select function_term, count(*) as n, count(gene) as n_keyed from rows
where not exists (select 1 from bad where bad.gene = rows.gene and bad.rsid = rows.rsid) group by 1
""")
def without_ambiguous_keys(t: Tables) -> DataFrame:
    rows = crosswalk(t).filter("usable_label").withColumn("gene", F.nullif("gene", F.lit(7)))
    bad = keys.conflicting_keys(rows, ["gene", "rsid"], "function_term")
    kept = keys.without_keys(rows, ["gene", "rsid"], bad)
    return kept.groupBy("function_term").agg(F.count(F.lit(1)).alias("n"), F.count("gene").alias("n_keyed"))


@query(CROSSWALK_SQL + "select gene, rsid, allele_name, function_term from cw qualify row_number() over (partition by gene, rsid order by src_ord) = 1")
def first_per_key(t: Tables) -> DataFrame:
    first = keys.first_per_key(crosswalk(t), ["gene", "rsid"], [F.col("src_ord")])
    return first.select("gene", "rsid", "allele_name", "function_term")


@query("""
with al as (select o_custkey as gene, o_orderpriority as allele_name from orders where o_orderpriority <> '5-LOW'),
labels as (
    select c_custkey as gene, '1-URGENT' as allele_name, 'Normal function' as function_term from customer
    union all select c_custkey, '2-HIGH', 'No function' from customer
    union all select c_custkey, '1-URGENT', 'Decreased function' from customer where c_acctbal < 0)
select allele_name, function_term, count(*) as n from al left join labels using (gene, allele_name) group by 1, 2
""")
def crosswalk_join(t: Tables) -> DataFrame:
    """Padded names on one side, duplicate labels for some keys, no label for others."""
    alleles = t.orders.filter(filters.not_reference(F.col("o_orderpriority"), "5-LOW")).select(
        F.col("o_custkey").alias("gene"), F.concat(F.lit(" "), F.col("o_orderpriority")).alias("allele_name")
    )
    pair = F.array(F.struct(F.lit("1-URGENT "), F.lit("Normal function")), F.struct(F.lit("2-HIGH"), F.lit("No function")))
    extra = F.array(F.struct(F.lit("1-URGENT"), F.lit("Decreased function")))
    listed = F.when(F.col("c_acctbal") < 0, F.concat(pair, extra)).otherwise(pair)
    labels = t.customer.select(F.col("c_custkey").alias("gene"), F.inline(listed).alias("allele_name", "function_term"))
    joined = keys.attach_labels(alleles, labels, ["gene", "allele_name"])
    return joined.groupBy("allele_name", "function_term").agg(F.count(F.lit(1)).alias("n"))


def _variants(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey")
    return t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("GeneSymbol"), F.year("l_shipdate").alias("rsid_norm"), "l_returnflag", "l_quantity"
    )


def gold(t: Tables, strict: bool) -> DataFrame:
    settled = keys.settled_labels(
        crosswalk(t), ["gene", "rsid"], "function_term", "usable_label", "allele_name", ["src_ord"], strict
    ).withColumnRenamed("allele_name", "defining_allele")
    return _variants(t).join(settled, (F.col("GeneSymbol") == F.col("gene")) & (F.col("rsid_norm") == F.col("rsid")))


def _gold_sql(strict: bool) -> str:
    scope = "true" if strict else "usable_label"
    return CROSSWALK_SQL + f"""
, bad as (select gene, rsid from cw where {scope} group by 1, 2 having count(distinct function_term) > 1),
settled as (
    select gene, rsid, allele_name as defining_allele, function_term from cw
    where usable_label and not exists (select 1 from bad where bad.gene = cw.gene and bad.rsid = cw.rsid)
    qualify row_number() over (partition by gene, rsid order by src_ord) = 1),
gold as (
    select s.*, l.l_returnflag, l.l_quantity from lineitem l join orders o on l_orderkey = o_orderkey
    join settled s on s.gene = o.o_custkey and s.rsid = year(l.l_shipdate))
"""


GOLD_SUMMARY_SQL = """
select function_term, count(*) as n_rows, count(distinct gene) as n_genes, count(distinct defining_allele) as n_alleles,
    cast(sum(l_quantity) as bigint) as quantity from gold group by 1
"""


def _gold_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("function_term").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("gene").alias("n_genes"),
        F.count_distinct("defining_allele").alias("n_alleles"), F.sum("l_quantity").cast("bigint").alias("quantity"),
    )


@query(_gold_sql(False) + GOLD_SUMMARY_SQL)
def gold_build(t: Tables) -> DataFrame:
    return _gold_summary(gold(t, strict=False))


@query(_gold_sql(True) + GOLD_SUMMARY_SQL)
def gold_build_strict(t: Tables) -> DataFrame:
    return _gold_summary(gold(t, strict=True))


@query(_gold_sql(False) + "select l_returnflag, function_term, count(*) as n from gold group by 1, 2")
def gold_label_counts(t: Tables) -> DataFrame:
    return summaries.value_counts(gold(t, strict=False), ["l_returnflag", "function_term"])


@query("""
select "column", n_present, n_total from (
    select 'priority' as "column", count(nullif(o_orderpriority, '5-LOW')) as n_present, count(*) as n_total from orders
    union all select 'status', count(nullif(o_orderstatus, 'F')), count(*) from orders
    union all select 'price', count(o_totalprice), count(*) from orders)
""")
def coverage(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"), F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.col("o_totalprice").alias("price"),
    )
    return summaries.coverage(rows, ["priority", "status", "price"])


RAW_SQL = """
with raw as (
    select o_orderkey, case o_orderpriority when '4-NOT SPECIFIED' then '-1' when '5-LOW' then 'nan' when '2-HIGH' then 'abc'
            when '3-MEDIUM' then o_custkey || '.7' else cast(o_custkey as varchar) end as rs,
        case o_orderstatus when 'F' then ' mt ' when 'O' then 'chr' || (o_orderpriority[1]) else o_orderpriority[1] end as chrom,
        case when o_totalprice < 20000 then 'unknown' else o_orderkey || '.0' end as start,
        case when o_totalprice > 400000 then '' when o_totalprice > 300000 then null else o_orderstatus end as ref,
        substr(o_orderpriority, 3, 1) as alt
    from orders)
"""


def _raw(t: Tables) -> DataFrame:
    priority, status, price = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice")
    custkey, digit = F.col("o_custkey").cast("string"), F.substring("o_orderpriority", 1, 1)
    return t.orders.select(
        "o_orderkey",
        F.when(priority == "4-NOT SPECIFIED", "-1").when(priority == "5-LOW", "nan").when(priority == "2-HIGH", "abc")
        .when(priority == "3-MEDIUM", F.concat(custkey, F.lit(".7"))).otherwise(custkey).alias("rs"),
        F.when(status == "F", F.lit(" mt ")).when(status == "O", F.concat(F.lit("chr"), digit)).otherwise(digit).alias("chrom"),
        F.when(price < 20000, "unknown").otherwise(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0"))).alias("start"),
        F.when(price > 400000, "").when(price > 300000, None).otherwise(status).alias("ref"),
        F.substring("o_orderpriority", 3, 1).alias("alt"),
    )


@query(RAW_SQL + """
select o_orderkey, case when rs not in ('-1', 'nan') then 'rs' || cast(trunc(try_cast(rs as double)) as bigint) end as rsid,
    cast(trunc(try_cast(start as double)) as bigint) as position,
    case when upper(trim(chrom)) in ('MT', 'M') then 'chrM' when starts_with(trim(chrom), 'chr') then trim(chrom)
        else 'chr' || trim(chrom) end as chrom_name,
    replace(chrom, 'chr', '') as bare_chrom,
    cast(trunc(try_cast(start as double)) as bigint) - 1 as start0
from raw
""")
def identifiers(t: Tables) -> DataFrame:
    position = text.whole_number(F.col("start"))
    return _raw(t).select(
        "o_orderkey", text.rsid(F.col("rs")).alias("rsid"), position.alias("position"), text.chrom_name(F.col("chrom")).alias("chrom_name"),
        text.without_chr(F.col("chrom")).alias("bare_chrom"), text.zero_based_start(position).alias("start0"),
    )


@query(RAW_SQL + """
, keyed as (select *, cast(trunc(try_cast(start as double)) as bigint) as pos, ref is not null and ref <> '' as has_ref,
        case when rs not in ('-1', 'nan') then 'rs' || cast(trunc(try_cast(rs as double)) as bigint) end as rsid from raw)
select o_orderkey,
    case when has_ref then replace(chrom, 'chr', '') || ' ' || pos || ' ' || coalesce(rsid, '.') || ' ' || ref || ' ' || alt || ' . . .' end as region,
    case when has_ref then 'chr' || replace(chrom, 'chr', '') || ':g.' || pos || ref || '>' || alt end as hgvs,
    coalesce(length(ref) = 1 and length(alt) = 1, false) as is_snv
from keyed
""")
def region_and_hgvs(t: Tables) -> DataFrame:
    c = F.col
    return _raw(t).select(
        "o_orderkey", text.region_key(c("chrom"), c("start"), text.rsid(c("rs")), c("ref"), c("alt")).alias("region"),
        text.hgvs(c("chrom"), c("start"), c("ref"), c("alt")).alias("hgvs"), text.is_snv(c("ref"), c("alt")).alias("is_snv"),
    )


@query("""
with n as (select l_orderkey || '-' || l_partkey || ' ' || repeat(l_returnflag || '=' || l_linestatus || ' ', l_linenumber * 8) as name, l_discount, l_quantity from lineitem)
select case when length(name) > 60 then substr(name, 1, 60) || '...' else name end as short_name,
    printf('%.1f%%', l_discount * 100) as confidence_text, cast(floor(l_discount * 100) as int) as bar_width,
    replace(trim(name), ' ', '_') as label, count(*) as n
from n group by all
""")
def display_text(t: Tables) -> DataFrame:
    mark = F.concat(F.col("l_returnflag"), F.lit("="), F.col("l_linestatus"), F.lit(" "))
    name = F.concat(
        F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"), F.lit(" "),
        F.repeat(mark, F.col("l_linenumber") * 8),
    )
    shown = t.lineitem.select(name.alias("name"), "l_discount").withColumns(display_columns(F.col("name"), F.col("l_discount")))
    labelled = shown.withColumn("label", text.snake_label(F.trim("name")))
    return labelled.groupBy("short_name", "confidence_text", "bar_width", "label").agg(F.count(F.lit(1)).alias("n"))


@query("""
select feature, case when starts_with(feature, 'num__') then substr(feature, 6) else substr(feature, 30) end as plain, count(*) as n
from (select case when p_size > 20 then 'num__' || p_type else 'cat__most_severe_consequence_' || p_brand end as feature from part)
group by all
""")
def feature_names(t: Tables) -> DataFrame:
    feature = F.when(F.col("p_size") > 20, F.concat(F.lit("num__"), F.col("p_type"))).otherwise(
        F.concat(F.lit("cat__most_severe_consequence_"), F.col("p_brand"))
    )
    return t.part.select(feature.alias("feature")).withColumn("plain", text.plain_feature(F.col("feature"))).groupBy("feature", "plain").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""
select o_orderkey, case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 when '3-MEDIUM' then 2 when '5-LOW' then 3 end as rank
from orders
""")
def ordinal_map(t: Tables) -> DataFrame:
    order = {priority: rank for rank, priority in enumerate(USABLE)}
    return t.orders.select("o_orderkey", text.ordinal(F.col("o_orderpriority"), order).alias("rank"))


@query("select doc_id, lang, source from documents where doc_id not in (select doc_id from labels)")
def unlabelled_pool(t: Tables) -> DataFrame:
    return keys.unlabelled_pool(t.documents, t.labels, ["doc_id"]).select("doc_id", "lang", "source")


@query("""
select verdict, count(*) as n from (
    select case when nullif(o_orderstatus, 'F') is not null then 'ok' else 'quarantine' end as verdict from orders
    union all
    select 'incomplete' from orders where nullif(o_orderpriority, '5-LOW') is null or nullif(o_orderstatus, 'O') is null) group by 1
""")
def quarantine_split(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.nullif("o_orderstatus", F.lit("F")).alias("key"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("a"),
        F.nullif("o_orderstatus", F.lit("O")).alias("b"),
    )
    kept, aside = filters.split(rows, F.col("key").isNotNull())
    incomplete = rows.filter(filters.any_missing("a", "b"))
    marked = [part.select(F.lit(name).alias("verdict")) for part, name in ((kept, "ok"), (aside, "quarantine"), (incomplete, "incomplete"))]
    return summaries.value_counts(marked[0].unionByName(marked[1]).unionByName(marked[2]), ["verdict"])


@query("""
select p_type, count(*) as n from part where p_type in (select p_type from part group by 1 having count(*) >= (1000.0 / 6000) * (select count(*) from part))
group by 1
""")
def frequent_classes(t: Tables) -> DataFrame:
    parts = t.part
    at_least = -(-parts.count() * 1000 // 6000)
    return summaries.value_counts(filters.without_rare_classes(parts, "p_type", at_least), ["p_type"])


@query("""
select origin, term, count(*) as n from (
    select 'gold' as origin, o_orderpriority as term from orders where o_orderpriority <> '4-NOT SPECIFIED'
    union all select 'pool', 'pool' from orders where o_orderpriority = '4-NOT SPECIFIED') group by 1, 2
""")
def union_and_split_back(t: Tables) -> DataFrame:
    """Gold and pool rows in one table, told apart by origin and never by position."""
    labelled, pool = filters.split(t.orders, filters.usable(F.col("o_orderpriority"), USABLE))
    together = labelled.select(F.lit("gold").alias("origin"), F.col("o_orderpriority").alias("term")).unionByName(
        pool.select(F.lit("pool").alias("origin"), F.lit("pool").alias("term"))
    )
    gold_rows, pool_rows = filters.split(together, F.col("origin") == "gold")
    return summaries.value_counts(gold_rows.unionByName(pool_rows), ["origin", "term"])


@query("select o_orderkey, o_orderpriority from orders order by o_orderpriority desc, o_orderkey limit 10")
def preview(t: Tables) -> DataFrame:
    return filters.preview(t.orders.select("o_orderkey", "o_orderpriority"), 10, [F.desc("o_orderpriority"), "o_orderkey"])


@query("""
select p_partkey, cast(dense_rank() over (order by p_type) - 1 as double) as label_index, p_type as decoded from part
""")
def label_encoding(t: Tables) -> DataFrame:
    """Class indices follow the sorted class names, and lead back to them."""
    classes = features.sorted_classes(t.part, "p_type")
    encoded = t.part.select("p_partkey", features.class_index("p_type", classes).alias("label_index"))
    return encoded.withColumn("decoded", features.class_name(F.col("label_index"), classes))
