"""ERP relations derived from the driver's TPC-H-like tables (test fixture).

In production the reports read the ERP tables themselves (JDBC or a Parquet
landing zone, see ``sources.jdbc``/``sources.parquet_io``). For tests and the
benchmark the 25 relations are *derived* from the driver tables by the texts
below, so that the work of every report grows with the driver data.

Each text names its inputs as ``{lineitem}``, ``{orders}``... Spark receives
the driver DataFrames as ``spark.sql`` arguments; the DuckDB oracle receives
the plain view names (see ``oracle_prelude``). Both engines run the same text,
except ``pchistest`` whose Spark form is written as an equi-join (see below).
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.sources.tables import DriverTables

# Fixed mapping texts (from FIXTURES.md part 3). Values and codes are part of
# the fixture definition and must stay exactly as written.
ERP_VIEWS: dict[str, str] = {
    "pcmov": """
select cast(l_partkey % 10 + 1 as int) as codfilial, l_orderkey as numped, l_partkey as codprod, l_suppkey as codfornec,
  o_custkey as codcli, cast(o_custkey % 27 as int) as codusur, cast(o_orderdate as date) as dtmov,
  cast(l_quantity as decimal(18,2)) as qt, cast(l_extendedprice as decimal(18,2)) as punit,
  case when l_linenumber = 7 then null else cast(l_tax as decimal(18,2)) end as vlfrete_rateio,
  case when l_linenumber = 6 then null else cast(l_tax as decimal(18,2)) end as vloutrasdesp,
  case when l_linenumber = 5 then null else cast(l_discount as decimal(18,2)) end as vloutros,
  case when l_returnflag = 'A' then null else cast(l_discount as decimal(18,2)) end as st,
  cast(l_tax as decimal(18,2)) as vlipi,
  case when l_linenumber = 4 then cast(l_discount as decimal(18,2)) end as vlrepasse,
  case when l_linestatus = 'F' then 'S' else 'E' end as codoper,
  case when l_returnflag = 'R' then cast(l_shipdate as date) end as dtcancel,
  l_linenumber as numlote, cast(l_shipdate as date) as datavalidade
from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "pcpedc": """
select o_orderkey as numped, o_orderkey + 1000000 as numtransvenda, cast(o_orderdate as date) as data, o_custkey as codcli, cast(o_custkey % 27 as int) as codusur,
  case when o_orderkey % 3 = 0 then 8888 else cast(o_custkey % 26 as int) end as codemitente,
  cast(o_orderkey % 10 + 1 as int) as codfilial,
  case o_orderpriority when '1-URGENT' then 'PE' when '2-HIGH' then 'OL' when '3-MEDIUM' then 'XX' end as tipofv,
  case o_orderkey % 5 when 0 then 'F' when 1 then 'F' when 2 then 'T' when 3 then 'W' end as origemped,
  cast(o_orderkey % 7 as int) as condvenda,
  case when o_orderstatus = 'P' and o_orderkey % 2 = 0 then cast(o_orderdate as date) end as dtcancel,
  case o_orderkey % 9 when 0 then 'P' when 1 then 'B' when 2 then 'L' when 3 then 'F' when 4 then 'C' when 5 then 'R' when 6 then 'D' when 7 then 'M' end as posicao,
  cast(o_totalprice as decimal(18,2)) as vltotal, case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) end as vlatend
from {orders}""",
    "pcpedi": """
select l_orderkey as numped, l_partkey as codprod, cast(l_quantity as decimal(18,2)) as qt, cast(l_extendedprice as decimal(18,2)) as pvenda,
  l_linestatus as posicao, case when l_returnflag = 'R' then cast(l_quantity as decimal(18,2)) end as qtfalta, l_linenumber as numlote,
  case when l_partkey % 4 = 0 then cast(l_partkey % 12 as int) end as codpromocaomed
from {lineitem}""",
    "pcpromocaomed": """
select distinct p_size % 10 as codpromocaomed, 'PROMO ' || cast(p_size % 10 as varchar(4)) as descricaoresumida from {part}""",
    "pcprodut": """
select p_partkey as codprod, p_name as descricao, p_partkey % 11 as codfornec, p_size % 5 as codepto, p_type as codsec, p_brand as codcategoria,
  case when p_size % 2 = 0 then 'S' else 'N' end as estoqueporlote,
  case when p_partkey % 40 = 0 then date '2000-01-01' end as dtexclusao
from {part}""",
    "pcdepto": """
select distinct p_size % 5 as codepto, case p_size % 5 when 0 then 'IMOBILIZADO' when 1 then ' Medicamentos ' when 2 then 'HIGIENE' else 'BELEZA' end as descricao from {part} where p_size % 5 <> 4""",
    "pcsecao": """
select distinct p_type as codsec, p_size % 5 as codepto, p_type as descricao from {part} where p_size % 5 <> 3""",
    "pccategoria": """
select distinct p_brand as codcategoria, p_type as codsec, p_brand as categoria from {part} where p_brand <> 'Brand#1'""",
    "pcfornec": """
select s_suppkey as codfornec, s_name as fornecedor, case s_nationkey % 3 when 0 then 'F' when 1 then 'H' else 'X' end as classificacao,
  s_nationkey as codcomprador, s_suppkey as codcli, case when s_suppkey % 4 = 0 then 'N' else 'S' end as revenda from {supplier}""",
    "pcempr": """
select n_nationkey as matricula, n_name as nome, n_nationkey as codusur from {nation} where n_nationkey <> 15""",
    "pcusuari": """
select n_nationkey as codusur, n_name as nome, n_regionkey as codsupervisor from {nation}""",
    "pcsuperv": """
select r_regionkey as codsupervisor, r_name as nome from {region} where r_regionkey <> 4""",
    "pcclient": """
select c_custkey as codcli, c_name as cliente, case when c_custkey % 3 = 0 then null else lower(c_name) end as fantasia, c_custkey % 100 as codcliprinc,
  case c_custkey % 6 when 0 then null when 1 then ' - ' when 2 then ' 123.456.' || cast(c_custkey as varchar(12)) || '-09 ' when 3 then '12.345.678/0001-' || cast(c_custkey as varchar(12)) when 4 then cast(c_custkey as varchar(12)) else '123456789012345' || cast(c_custkey as varchar(12)) end as cgcent,
  case when c_custkey % 2 = 0 then 'F' else 'J' end as tipofj, c_nationkey as codpraca from {customer}""",
    "pchistest": """
select cast(l_partkey % 10 + 1 as int) as codfilial, l_partkey as codprod, date '1999-09-01' + cast(l_orderkey % 490 as int) as data,
  cast((l_partkey * 7 + l_orderkey % 490 * 3) % 60 - 6 as int) as qtestger, max(cast(p_retailprice as decimal(18,2))) as custorep
from {lineitem} join {part} on l_partkey = p_partkey group by l_partkey, l_orderkey % 490""",
    "pcest": """
select cast(p_partkey % 10 + 1 as int) as codfilial, p_partkey as codprod, p_size * 10 - 20 as qtestger, p_size % 7 as qtgirodia,
  case when p_partkey % 50 = 0 then null else cast(p_retailprice as decimal(18,2)) end as custoultent,
  cast(p_retailprice as decimal(18,2)) as valorultent, date '1999-06-01' + cast(p_partkey % 400 as int) as dtprimcompra from {part}""",
    "pcverba": """
select o_orderkey as numverba, cast(o_orderkey % 10 + 1 as int) as codfilial, cast(o_orderdate as date) as dtcadastro, cast(o_orderdate as date) + 30 as dtvenc,
  o_custkey % 11 as codfornec, '40' || cast(o_orderkey % 10 as varchar(4)) as codconta, o_orderkey + 500 as numnota, cast(null as bigint) as numtransentdevfornec,
  case when o_orderkey % 4 = 0 then null else 'REF' end as referencia, cast(null as varchar(10)) as referencia1,
  case when o_orderstatus = 'P' then cast(o_orderdate as date) + 5 end as dtcancel, cast(o_totalprice as decimal(18,2)) as valor from {orders}""",
    "pcaplicverba": """
select l_orderkey as numverba, cast(l_extendedprice as decimal(18,2)) as vlaplic, case when l_returnflag = 'R' then cast(l_shipdate as date) end as dtestorno from {lineitem}""",
    "pcmovcrfor": """
select l_orderkey as numverba, case when l_linestatus = 'F' then 'D' else 'C' end as tipo, cast(l_extendedprice as decimal(18,2)) as valor,
  case when l_returnflag = 'R' then cast(l_shipdate as date) end as dtestorno from {lineitem}""",
    "pcprest": """
select o_orderkey as numped, o_orderkey + 1000000 as numtransvenda, cast(o_orderkey % 10 + 1 as int) as codfilial, cast(o_custkey % 10 as bigint) as codcli, cast(o_custkey % 27 as int) as codusur,
  case when o_orderkey % 2 = 0 then cast(o_orderkey % 5 as int) end as codsupervisor, cast(o_orderdate as date) as dtemissao, cast(o_orderdate as date) + 30 as dtvenc,
  case when o_orderstatus = 'F' then cast(o_orderdate as date) + 40 end as dtpag, case when o_orderkey % 50 = 0 then cast(o_orderdate as date) end as dtcancel,
  case o_orderkey % 8 when 0 then 'DESD' when 1 then 'DEVP' when 2 then null when 3 then 'CRED' when 4 then 'CH' else 'BK' end as codcob,
  case when o_orderkey % 20 = 0 then cast(0 as decimal(18,2)) else cast(o_totalprice as decimal(18,2)) end as valor,
  cast(o_orderkey % 3 + 1 as varchar(4)) as prest, o_orderkey + 2000000 as duplic, case when o_orderkey % 4 = 0 then cast(o_custkey as decimal(18,2)) end as vpago,
  cast(o_orderkey % 6 as decimal(18,2)) as txperm, case when o_orderkey % 5 = 0 then cast(o_custkey % 90 as decimal(18,2)) end as valordesc,
  case when o_orderkey % 9 = 0 then cast(o_custkey % 70 as decimal(18,2)) end as vldevol, case when o_orderkey % 9 = 0 then cast(o_orderdate as date) + 20 end as dtdevol,
  cast(o_custkey % 27 + 100 as bigint) as codemitentepedido from {orders}""",
    "pccob": """
select 'BK' as codcob union all select 'CH' union all select 'CRED' union all select 'DESD'""",
    "pclib": """
select '8' as codtabela, 608 as codfunc, 'BK' as codigoa, cast(null as int) as codigon union all select '8', 608, cast(null as varchar(4)), cast(null as int)
union all select '7', 608, '1', 1 union all select '7', 608, '2', 2 union all select '7', 1, '9999', 9999""",
    "pcendereco": """
select s_suppkey as codendereco, cast(s_suppkey % 10 + 1 as int) as codfilial, case when s_suppkey % 2 = 0 then 'AP' else 'PK' end as tipoender from {supplier}""",
    "pcestendereco": """
select l_suppkey as codendereco, l_partkey as codprod, sum(cast(l_quantity as decimal(18,2))) - 20 as qt, max(cast(l_shipdate as date)) as dtval from {lineitem} group by l_suppkey, l_partkey""",
    "pcestenderecoi": """
select l_suppkey as codendereco, l_partkey as codprod, cast(l_linenumber as varchar(4)) as numlote, case when l_returnflag = 'N' then null else cast(l_shipdate as date) end as dtval,
  case when l_linenumber = 3 then null else cast(l_quantity as decimal(18,2)) end as qt from {lineitem}""",
    "pcprodfilial": """
select p_partkey as codprod, p_partkey % 10 + 1 as codfilial, case when p_partkey % 3 = 0 then 'S' else 'N' end as estoquepordtvalidadepk from {part}
union all select p_partkey, (p_partkey + 1) % 10 + 1, 'N' from {part} where p_partkey % 5 = 0""",
    "pcfilial": """
select codigo, 'FILIAL ' || cast(codigo as varchar(4)) as razaosocial from (select distinct cast(p_partkey % 10 + 1 as int) as codigo from {part}) b""",
}

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

def oracle_prelude(names: list[str] | None = None) -> str:
    """``WITH`` list defining the ERP views over DuckDB's driver views."""
    names = names or list(ERP_VIEWS)
    plain = {t: t for t in DRIVER_TABLES}
    parts = [f"{name} AS ({ERP_VIEWS[name].format(**plain).strip()})" for name in names]
    return ",\n".join(parts)


class ErpTables:
    """Lazy dictionary of ERP relations for one driver-table folder.

    Nothing is read or cached here: every relation is a logical plan that
    Catalyst prunes and pushes filters into when a report uses it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.driver = DriverTables(spark, sf_dir)
        self._views: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._views:
            self._views[name] = self._build(name)
        return self._views[name]

    def __contains__(self, name: str) -> bool:
        return name in ERP_VIEWS

    def keys(self):
        return ERP_VIEWS.keys()

    def _build(self, name: str) -> DataFrame:
        text = ERP_VIEWS[name]
        args = {t: self.driver[t] for t in DRIVER_TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **args)
