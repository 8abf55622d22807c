WITH wide AS (
  SELECT ANOCADASTRO,
         SUM(CASE WHEN STATUS_VENCIMENTO = 'VENCIDA' THEN SALDO_A_RECEBER ELSE 0 END) AS VENCIDA,
         SUM(CASE WHEN STATUS_VENCIMENTO = 'A VENCER' THEN SALDO_A_RECEBER ELSE 0 END) AS AVENCER
  FROM fund_base GROUP BY ANOCADASTRO),
long AS (
  SELECT ANOCADASTRO, 'VENCIDA' AS STATUS, VENCIDA AS SALDO_PENDENTE FROM wide
  UNION ALL
  SELECT ANOCADASTRO, 'AVENCER' AS STATUS, AVENCER AS SALDO_PENDENTE FROM wide)
SELECT ANOCADASTRO, STATUS, CAST(SALDO_PENDENTE AS DOUBLE) AS SALDO_PENDENTE FROM long WHERE SALDO_PENDENTE > 0
