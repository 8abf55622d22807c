SELECT * REPLACE (CAST(VALORVERBA AS DOUBLE) AS VALORVERBA, CAST(VALOR_APLICADO_TOTAL AS DOUBLE) AS VALOR_APLICADO_TOTAL,
                  CAST(VALOR_DEBITO AS DOUBLE) AS VALOR_DEBITO, CAST(VALOR_CREDITO AS DOUBLE) AS VALOR_CREDITO,
                  CAST(SALDO_A_RECEBER AS DOUBLE) AS SALDO_A_RECEBER, CAST(SALDO_A_APLICAR AS DOUBLE) AS SALDO_A_APLICAR)
FROM fund_base
