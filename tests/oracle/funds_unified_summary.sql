WITH u AS (
  SELECT 'ACOMPANHAMENTO' AS TIPO_VERBA, CLASSIFICACAO, COMPRADOR, STATUS_VENCIMENTO AS STATUS_UNIFICADO,
         CAST(SALDO_A_RECEBER AS DECIMAL(38, 6)) AS VALOR
  FROM fund_base
  UNION ALL
  SELECT 'DEVOLUCAO', CLASSIFICACAO, COMPRADOR, STATUS_VENCIDOS, CAST(VALOR_VERBA_DEVOLUCAO AS DECIMAL(38, 6))
  FROM returns_aged WHERE STATUS_VERBA = 'PENDENTE')
SELECT CLASSIFICACAO, COMPRADOR, TIPO_VERBA, STATUS_UNIFICADO, CAST(SUM(VALOR) AS DOUBLE) AS SALDO_PENDENTE,
       COUNT(*) AS QTD_REGISTROS
FROM u
WHERE VALOR > 0 AND CLASSIFICACAO IS NOT NULL AND COMPRADOR IS NOT NULL AND STATUS_UNIFICADO IS NOT NULL
GROUP BY CLASSIFICACAO, COMPRADOR, TIPO_VERBA, STATUS_UNIFICADO
