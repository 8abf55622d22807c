SELECT CODIGOFILIAL, COMPRADOR, CAST(COALESCE(SUM(VALOR_VERBA), 0) AS DOUBLE) AS Soma_de_VALOR_VERBA
FROM r15_main GROUP BY CODIGOFILIAL, COMPRADOR
