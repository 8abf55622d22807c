SELECT FORNECEDOR, CAST(COALESCE(SUM(VALOR_VERBA_DEVOLUCAO), 0) AS DOUBLE) AS Soma_de_VALOR_VERBA_DEVOLUCAO
FROM r15_dev GROUP BY FORNECEDOR
