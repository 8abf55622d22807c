"""Declared schemas of every input relation and file, drift detection and the missing-input guard (S10, P19, SURVEY section 1).

The schema of an input is declared here, never inferred. ``conform`` compares a
relation that was read with its declaration and either returns it in the declared
columns and types or raises ``SchemaDrift`` with every difference:

* a missing column that the declaration marks as optional becomes its default;
  any other missing column is drift;
* a type that widens without loss (int to bigint, a decimal with no more digits
  before or after the point, date from a timestamp without zone) is cast; any
  other type is drift;
* extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StringType, StructField, StructType, TimestampNTZType, TimestampType)

MONEY, WIDE_QUANTITY, LEDGER_SUM = "decimal(18,2)", "decimal(29,2)", "decimal(28,6)"

# Relations of the ERP that the reports read.
ERP_DDL: dict[str, str] = {
    "pcmov": "codfilial int, numped bigint, codprod bigint, codfornec bigint, codcli bigint, codusur int, dtmov date, "
             f"qt {MONEY}, punit {MONEY}, vlfrete_rateio {MONEY}, vloutrasdesp {MONEY}, vloutros {MONEY}, st {MONEY}, vlipi {MONEY}, "
             f"vlrepasse {MONEY}, codoper string, dtcancel date, numlote int, datavalidade date",
    "pcpedc": "numped bigint, numtransvenda bigint, data date, codcli bigint, codusur int, codemitente int, codfilial int, "
              f"tipofv string, origemped string, condvenda int, dtcancel date, posicao string, vltotal {MONEY}, vlatend {MONEY}",
    "pcpedi": f"numped bigint, codprod bigint, qt {MONEY}, pvenda {MONEY}, posicao string, qtfalta {MONEY}, numlote int, codpromocaomed int",
    "pcpromocaomed": "codpromocaomed int, descricaoresumida string",
    "pcprodut": "codprod bigint, descricao string, codfornec bigint, codepto int, codsec string, codcategoria string, "
                "estoqueporlote string, dtexclusao date",
    "pcdepto": "codepto int, descricao string",
    "pcsecao": "codsec string, codepto int, descricao string",
    "pccategoria": "codcategoria string, codsec string, categoria string",
    "pcfornec": "codfornec bigint, fornecedor string, classificacao string, codcomprador int, codcli bigint, revenda string",
    "pcempr": "matricula int, nome string, codusur int",
    "pcusuari": "codusur int, nome string, codsupervisor int",
    "pcsuperv": "codsupervisor int, nome string",
    "pcclient": "codcli bigint, cliente string, fantasia string, codcliprinc bigint, cgcent string, tipofj string, codpraca int",
    "pchistest": f"codfilial int, codprod bigint, data date, qtestger int, custorep {MONEY}",
    "pcest": f"codfilial int, codprod bigint, qtestger int, qtgirodia int, custoultent {MONEY}, valorultent {MONEY}, dtprimcompra date",
    "pcverba": "numverba bigint, codfilial int, dtcadastro date, dtvenc date, codfornec bigint, codconta string, numnota bigint, "
               f"numtransentdevfornec bigint, referencia string, referencia1 string, dtcancel date, valor {MONEY}",
    "pcaplicverba": f"numverba bigint, vlaplic {MONEY}, dtestorno date",
    "pcmovcrfor": f"numverba bigint, tipo string, valor {MONEY}, dtestorno date",
    "pcprest": "numped bigint, numtransvenda bigint, codfilial int, codcli bigint, codusur int, codsupervisor int, dtemissao date, "
               f"dtvenc date, dtpag date, dtcancel date, codcob string, valor {MONEY}, prest string, duplic bigint, vpago {MONEY}, "
               f"txperm {MONEY}, valordesc {MONEY}, vldevol {MONEY}, dtdevol date, codemitentepedido bigint",
    "pccob": "codcob string",
    "pclib": "codtabela string, codfunc int, codigoa string, codigon int",
    "pcendereco": "codendereco bigint, codfilial int, tipoender string",
    "pcestendereco": f"codendereco bigint, codprod bigint, qt {WIDE_QUANTITY}, dtval date",
    "pcestenderecoi": f"codendereco bigint, codprod bigint, numlote string, dtval date, qt {MONEY}",
    "pcprodfilial": "codprod bigint, codfilial bigint, estoquepordtvalidadepk string",
    "pcfilial": "codigo int, razaosocial string",
}

# Columns that a relation may lack, with the value they then have.
ERP_OPTIONAL: dict[str, dict[str, object]] = {
    "pcprest": dict.fromkeys(("prest", "duplic", "vpago", "txperm", "valordesc", "vldevol", "dtdevol", "codemitentepedido")),
    "pcpedi": dict.fromkeys(("qtfalta", "codpromocaomed")),
}

# Files of the star schema. The two optional columns of the sales fact have the dashboard's defaults.
STAR_DDL: dict[str, str] = {
    "dim_produto": "cod_produto bigint, nm_produto string, categoria string, secao string, departamento string",
    "dim_filial": "cod_filial int, nm_filial string",
    "dim_fornecedor": "cod_fornecedor bigint, nm_fornecedor string, classificacao string",
    "dim_cliente": "cod_cliente bigint, nm_cliente string, tipo_pj string",
    "dim_vendedor": "cod_vendedor int, nm_vendedor string",
    "dim_supervisor": "cod_supervisor int, nm_supervisor string",
    "dim_televendas": "cod_televenda int, nm_televenda string",
    "dim_calendario": "ano int, mes int, indice int, primeiro_dia date",
    "fato_venda": "cod_filial int, data_movimentacao date, num_pedido bigint, cod_vendedor int, cod_televenda int, cod_supervisor int, "
                  "cod_cliente bigint, cod_fornecedor bigint, cod_produto bigint, num_lote int, data_validade date, "
                  "origem_pedido string, qt_vendida decimal(28,2), valor_bruto decimal(38,2), valor_liquido decimal(38,2)",
    "fato_pedido_venda": "numero_pedido bigint, numtransvenda bigint, data_pedido date, cod_cliente bigint, cod_vendedor int, "
                         "cod_emitente int, cod_filial int, cod_produto bigint, valor_total double, valor_atendido double, "
                         "vl_venda_unitario double, quantidade double, qtd_falta double, num_lote int, origem_pedido string, "
                         "posicao_pedido string",
    "fato_receber": "cod_cliente bigint, prestacao string, duplicata bigint, valor double, dt_vencimento date, valor_pago double, "
                    "txperm double, dt_pagamento date, dt_emissao date, cod_filial int, cod_vendedor int, vl_desconto double, "
                    "vl_devolucao double, dt_devolucao date, cod_supervisor int, numtransvenda bigint, numped bigint, "
                    "cod_emitente_pedido bigint",
}
STAR_OPTIONAL: dict[str, dict[str, object]] = {"fato_venda": {"cod_supervisor": 0, "origem_pedido": "N/I"}}

# The two CSV files of the fund analyses.
REPORT_DDL: dict[str, str] = {
    "fund_ledger": "CODIGOFILIAL int, CLASSIFICACAO string, DATACADASTRO date, CODIGOFORNECEDOR bigint, FORNECEDOR string, "
                   "CODCOMPRADOR bigint, COMPRADOR string, CODIGOCONTA bigint, NUMEROVERBA bigint, NUMNOTA bigint, "
                   "NUMEROTRANSVENDA bigint, DATAVENCIMENTO date, REFERENCIA string, REFERENCIA1 string, SITUACAO string, "
                   f"VALOR_VERBA {MONEY}, VALORAPLICADO decimal(28,2), ESTORNOAPLIC string, VALORDEBITO {LEDGER_SUM}, "
                   f"VALORCREDITO {LEDGER_SUM}, ESTORNOVERBA string",
    "returns_receivable": "CLASSIFICACAO string, FILIAL int, CODFORNEC bigint, FORNECEDOR string, COMPRADOR string, "
                          "VALOR_VERBA_DEVOLUCAO decimal(28,2), DTEMISSAO date, DATA_VENCIMENTO date, DATA_PAGAMENTO date",
}


_SIMPLE_TYPES = {"int": IntegerType(), "bigint": LongType(), "double": DoubleType(), "string": StringType(), "date": DateType()}
_COLUMN = re.compile(r"\s*(\w+) (?:(\w+)|decimal\((\d+),(\d+)\))\s*(?:,|$)")


def declared(columns: str) -> StructType:
    """Schema of ``name type, ...`` in the types used here; unlike ``StructType.fromDDL`` it needs no session."""
    fields, at = [], 0
    while at < len(columns):
        found = _COLUMN.match(columns, at)
        if not found or (found.group(2) and found.group(2) not in _SIMPLE_TYPES):
            raise ValueError(f"no declaration: {columns[at:]!r}")
        name, simple, precision, scale = found.groups()
        fields.append(StructField(name, _SIMPLE_TYPES[simple] if simple else DecimalType(int(precision), int(scale))))
        at = found.end()
    return StructType(fields)


ERP_SCHEMAS = {name: declared(ddl) for name, ddl in ERP_DDL.items()}
STAR_SCHEMAS = {name: declared(ddl) for name, ddl in STAR_DDL.items()}
REPORT_SCHEMAS = {name: declared(ddl) for name, ddl in REPORT_DDL.items()}


@dataclass(frozen=True)
class Difference:
    relation: str
    column: str
    declared: str
    found: str | None            # None: the column is missing

    def __str__(self) -> str:
        return f"{self.relation}.{self.column}: declared {self.declared}, found {self.found or 'no such column'}"


class SchemaDrift(ValueError):
    """An input whose columns or types are not the declared ones; ``differences`` lists all of them."""

    def __init__(self, differences: list[Difference]):
        self.differences = differences
        super().__init__("; ".join(map(str, differences)))


class MissingInput(FileNotFoundError):
    """A declared input without files."""


_INTEGERS = (ByteType, ShortType, IntegerType, LongType)


def widens(found: DataType, wanted: DataType) -> bool:
    """True when every value of ``found`` is a value of ``wanted``."""
    if found == wanted:
        return True
    if isinstance(wanted, DecimalType):
        if isinstance(found, DecimalType):
            return found.scale <= wanted.scale and found.precision - found.scale <= wanted.precision - wanted.scale
        digits = dict(zip(_INTEGERS, (3, 5, 10, 19))).get(type(found))
        return digits is not None and digits <= wanted.precision - wanted.scale
    if type(found) in _INTEGERS and type(wanted) in _INTEGERS:
        return _INTEGERS.index(type(found)) < _INTEGERS.index(type(wanted))
    if isinstance(wanted, DoubleType):
        return isinstance(found, (FloatType, ByteType, ShortType, IntegerType))
    return isinstance(wanted, DateType) and isinstance(found, (TimestampNTZType, TimestampType))


def differences(found: StructType, wanted: StructType, relation: str, optional: Mapping[str, object] | None = None) -> list[Difference]:
    """Every declared column that ``found`` lacks (unless optional) or holds in a type that does not widen to the declared one."""
    types = {f.name.lower(): f.dataType for f in found.fields}
    out = []
    for f in wanted.fields:
        have = types.get(f.name.lower())
        if have is None and f.name in (optional or {}):
            continue
        if have is None or not widens(have, f.dataType):
            out.append(Difference(relation, f.name, f.dataType.simpleString(), have.simpleString() if have is not None else None))
    return out


def conform(df: DataFrame, wanted: StructType, relation: str, optional: Mapping[str, object] | None = None) -> DataFrame:
    """``df`` in the declared columns and types; raises SchemaDrift. Only the schema is looked at: no job runs."""
    found = differences(df.schema, wanted, relation, optional)
    if found:
        raise SchemaDrift(found)
    present = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{present[f.name.lower()]}`") if f.name.lower() in present else F.lit((optional or {})[f.name])).cast(f.dataType).alias(f.name)
        for f in wanted.fields])


def empty(spark: SparkSession, wanted: StructType) -> DataFrame:
    return spark.createDataFrame([], wanted)
