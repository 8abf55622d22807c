SELECT CAST(COALESCE(SUM(VALORVERBA), 0) AS DOUBLE) AS TOTAL_VERBA,
       CAST(COALESCE(SUM(SALDO_A_RECEBER), 0) AS DOUBLE) AS SALDO_RECEBER,
       CAST(COALESCE(SUM(SALDO_A_APLICAR), 0) AS DOUBLE) AS SALDO_APLICAR,
       CAST(COALESCE(SUM(CASE WHEN STATUS_VENCIMENTO = 'VENCIDA' THEN SALDO_A_RECEBER ELSE 0 END), 0) AS DOUBLE) AS SALDO_VENCIDO
FROM fund_base
