SELECT * REPLACE (CAST(VALOR_VERBA_DEVOLUCAO AS DOUBLE) AS VALOR_VERBA_DEVOLUCAO) FROM returns_x
