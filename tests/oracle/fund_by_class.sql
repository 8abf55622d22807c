SELECT CLASSIFICACAO, CAST(COALESCE(SUM(VLR_RECEBER), 0) AS DOUBLE) AS Soma_de_VLR_RECEBER
FROM r15_main GROUP BY CLASSIFICACAO
