SELECT CLASSIFICACAO, FORNECEDOR, COMPRADOR, NUMERO_VERBA, CAST(VALORVERBA AS DOUBLE) AS VALORVERBA,
       CAST(VALOR_APLICADO_TOTAL AS DOUBLE) AS VALOR_APLICADO_TOTAL, CAST(VALOR_DEBITO AS DOUBLE) AS VALOR_DEBITO,
       CAST(VALOR_CREDITO AS DOUBLE) AS VALOR_CREDITO, CAST(SALDO_A_APLICAR AS DOUBLE) AS SALDO_A_APLICAR,
       CAST(SALDO_A_RECEBER AS DOUBLE) AS SALDO_A_RECEBER, DATA_VENCIMENTO, STATUS_VENCIMENTO, STATUS_VERBA, DIAS_VENCIDOS
FROM fund_base
WHERE STATUS_VENCIMENTO IN ('VENCIDA')
