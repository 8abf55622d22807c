WITH s AS (
  SELECT CLASSIFICACAO, SUM(SALDO_A_RECEBER) AS SALDO_A_RECEBER
  FROM fund_base
  WHERE STATUS_VERBA = 'ATIVA' AND STATUS_VENCIMENTO = 'VENCIDA' AND SALDO_A_RECEBER > 0
  GROUP BY CLASSIFICACAO)
SELECT CLASSIFICACAO, CAST(SALDO_A_RECEBER AS DOUBLE) AS SALDO_A_RECEBER,
       CAST(SALDO_A_RECEBER AS DOUBLE) * 100.0 / CAST((SELECT SUM(SALDO_A_RECEBER) FROM s) AS DOUBLE) AS PERCENTUAL
FROM s
