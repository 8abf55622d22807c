SELECT * REPLACE (CAST(VALOR_VERBA AS DOUBLE) AS VALOR_VERBA, CAST(VALORAPLICADO AS DOUBLE) AS VALORAPLICADO,
                  CAST(VALORDEBITO AS DOUBLE) AS VALORDEBITO, CAST(VALORCREDITO AS DOUBLE) AS VALORCREDITO)
FROM ledger_x
