SELECT FILIAL, CLASSIFICACAO, FORNECEDOR, COMPRADOR, CAST(SUM(VALOR_VERBA_DEVOLUCAO) AS DOUBLE) AS VALOR_VERBA_DEVOLUCAO
FROM returns_aged
WHERE STATUS_VERBA = 'PENDENTE' AND FILIAL IS NOT NULL AND CLASSIFICACAO IS NOT NULL AND FORNECEDOR IS NOT NULL
  AND COMPRADOR IS NOT NULL
GROUP BY FILIAL, CLASSIFICACAO, FORNECEDOR, COMPRADOR
