"""The store's tables as views over the benchmark's order-processing tables.

Each text runs unchanged in Spark and in DuckDB, so a report and its oracle read
the same rows. The source tables hold no NULL; the views turn values into NULL,
or into ids that lead nowhere, by fixed rules, and keep every row. Dimensions
grow with the tables they are taken from.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from salesdq.sources.store import Store

# fixed values: schemas of the benchmark's files, given to the reader so that
# building a query touches no file footer
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Four consecutive parts form an album, eight albums an artist.
VIEWS = {
    "s_customer": """
        select c.c_custkey as CustomerId,
               split_part(c.c_name, '#', 1) as FirstName,
               case when c.c_custkey % 17 = 0 then null else split_part(c.c_name, '#', 2) end as LastName,
               nullif(c.c_mktsegment, 'BUILDING') as Company,
               case when c.c_custkey % 7 = 0 then null else n.n_name end as City,
               case when c.c_acctbal < 0 then null else c.c_mktsegment end as State,
               r.r_name as Country,
               case when c.c_custkey % 13 = 0 then null else c.c_name end as Email,
               case when c.c_custkey % 11 = 0 or c.c_nationkey = 12 then null else c.c_nationkey end
                 as SupportRepId
        from {customer} c
        join {nation} n on c.c_nationkey = n.n_nationkey
        join {region} r on n.n_regionkey = r.r_regionkey""",
    # nations above 20 share a name with nation 2; nation 12 looks after nobody
    "s_employee": """
        select n.n_nationkey as EmployeeId,
               'Agent' as FirstName,
               case when n.n_nationkey > 20 then 'NATION_2' else n.n_name end as LastName,
               r.r_name as Title
        from {nation} n join {region} r on n.n_regionkey = r.r_regionkey""",
    # customers whose key ends in 3 have no invoices, their orders go to the one before
    "s_invoice": """
        select o_orderkey as InvoiceId,
               case when o_orderkey % 97 = 5 then null
                    when o_custkey % 10 = 3 then o_custkey - 1
                    else o_custkey end as CustomerId,
               o_orderdate as InvoiceDate,
               cast(o_totalprice as decimal(18,2)) as Total
        from {orders}""",
    "s_invoice_line": """
        select l_orderkey * 8 + l_linenumber as InvoiceLineId,
               l_orderkey as InvoiceId,
               case when l_linenumber = 7 and l_returnflag = 'R' then null else l_partkey end as TrackId,
               case when l_discount > 0.095 then null else cast(l_extendedprice as decimal(18,2)) end
                 as UnitPrice,
               case when l_tax > 0.075 then null else cast(l_quantity as int) end as Quantity
        from {lineitem}""",
    "s_track": """
        select p_partkey as TrackId,
               p_name as Name,
               case when p_size = 50 then null
                    when p_brand = 'Brand#25' then -1 - p_partkey
                    else cast(floor(p_partkey / 4) as bigint) end as AlbumId,
               nullif(p_type, 'PROMO') as GenreId,
               case when p_partkey % 5 = 0 then null
                    when p_size = 13 then '  '
                    else split_part(p_name, ' ', 1) end as Composer,
               case when p_size = 33 then null else p_size * 10000 end as Milliseconds,
               cast(p_retailprice as decimal(18,2)) as UnitPrice
        from {part}""",
    "s_album": """
        select cast(floor(p_partkey / 4) as bigint) as AlbumId,
               min(p_name) as Title,
               case when max(p_size) > 48 then null
                    when min(p_size) = 2 then cast(-1 as bigint)
                    else cast(floor(min(p_partkey) / 32) as bigint) end as ArtistId
        from {part} group by cast(floor(p_partkey / 4) as bigint)""",
    # of every five artists, the last is a namesake of the one before
    "s_artist": """
        select ArtistId,
               concat('Artist ', cast(ArtistId - case when ArtistId % 5 = 4 then 1 else 0 end as varchar(20)))
                 as Name
        from (select distinct cast(floor(p_partkey / 32) as bigint) as ArtistId from {part}) ids""",
    "s_genre": """
        select distinct p_type as GenreId, p_type as Name from {part} where p_type <> 'PROMO'""",
    "s_playlist": "select s_suppkey as PlaylistId, s_name as Name from {supplier}",
    "s_playlist_track": "select distinct l_suppkey as PlaylistId, l_partkey as TrackId from {lineitem}",
    # purchases carry a time of day, which orders do not
    "s_purchase": """
        select event_id as InvoiceId, user_id as CustomerId, ts as InvoiceDate,
               cast(value as decimal(18,2)) as Total
        from {events} where event_type = 'purchase'""",
    "s_purchase_line": """
        select event_id * 2 as InvoiceLineId, event_id as InvoiceId, user_id as TrackId,
               case when event_id % 19 = 0 then null else cast(value as decimal(18,2)) end as UnitPrice,
               cast(1 + event_id % 3 as int) as Quantity
        from {events} where event_type = 'purchase'
        union all
        select event_id * 2 + 1, event_id, user_id + 1, cast(value as decimal(18,2)), cast(1 as int)
        from {events} where event_type = 'purchase' and event_id % 4 = 0""",
}


def _sources(text: str) -> list[str]:
    return sorted(set(re.findall(r"{(\w+)}", text)))


def source(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """One of the benchmark's tables."""
    return spark.read.schema(SOURCE_SCHEMAS[table]).parquet(f"{directory}/{table}.parquet")


def view(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One of the store's tables, bound to the files in ``directory``."""
    text = VIEWS[name]
    return spark.sql(text, **{t: source(spark, directory, t) for t in _sources(text)})


@lru_cache
def view_sql(name: str) -> str:
    """The same view for an engine in which the source tables are registered by name."""
    text = VIEWS[name]
    return text.format(**{t: t for t in _sources(text)}).strip()


def store(spark: SparkSession, directory: str) -> Store:
    """All ten tables."""
    return Store(
        **{field: view(spark, directory, f"s_{field}") for field in Store.__dataclass_fields__}
    )
