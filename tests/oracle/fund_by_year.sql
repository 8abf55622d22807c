WITH s AS (SELECT ANO_EMISSAO, COALESCE(SUM(VLR_RECEBER), 0) AS v FROM r15_main GROUP BY ANO_EMISSAO)
SELECT ANO_EMISSAO, CAST(v AS DOUBLE) AS Soma_de_VLR_RECEBER FROM s
WHERE (SELECT bool_and(ANO_EMISSAO = 0) FROM s) OR ANO_EMISSAO > 0
