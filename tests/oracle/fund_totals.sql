SELECT CAST(COALESCE(SUM(VALOR_VERBA), 0) AS DOUBLE) AS SOMA_VALOR_VERBA,
       CAST(COALESCE(SUM(VALORDEBITO), 0) AS DOUBLE) AS SOMA_VALORDEBITO,
       CAST(COALESCE(SUM(VALORCREDITO), 0) AS DOUBLE) AS SOMA_VALORCREDITO,
       CAST(COALESCE(SUM(VLR_RECEBER), 0) AS DOUBLE) AS TOTAL_RECEBER,
       CAST((SELECT COALESCE(SUM(VALOR_VERBA_DEVOLUCAO), 0) FROM r15_dev) AS DOUBLE) AS SOMA_VALOR_DEVOLUCAO,
       CAST(COALESCE(SUM(VALOR_VERBA), 0) + COALESCE(SUM(VALORCREDITO), 0) AS DOUBLE) AS TOTAL_APLICAR
FROM r15_main
