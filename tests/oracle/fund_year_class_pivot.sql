SELECT ANOCADASTRO,
       CAST(COALESCE(SUM(CASE WHEN CLASSIFICACAO = 'FARMA' THEN SALDO_A_RECEBER END), 0) AS DOUBLE) AS FARMA,
       CAST(COALESCE(SUM(CASE WHEN CLASSIFICACAO = 'HB' THEN SALDO_A_RECEBER END), 0) AS DOUBLE) AS HB,
       CAST(COALESCE(SUM(CASE WHEN CLASSIFICACAO = 'NÃO CLASSIFICADO' THEN SALDO_A_RECEBER END), 0) AS DOUBLE) AS "NÃO CLASSIFICADO",
       CAST(COALESCE(SUM(CASE WHEN COALESCE(CLASSIFICACAO, '') NOT IN ('FARMA', 'HB', 'NÃO CLASSIFICADO') THEN SALDO_A_RECEBER END), 0) AS DOUBLE) AS OUTRAS
FROM fund_base
WHERE ANOCADASTRO >= 1997 AND SALDO_A_RECEBER > 0
GROUP BY ANOCADASTRO
