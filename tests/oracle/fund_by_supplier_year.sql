SELECT FORNECEDOR, ANO_EMISSAO, CAST(COALESCE(SUM(VLR_RECEBER), 0) AS DOUBLE) AS Soma_de_VLR_RECEBER
FROM r15_main GROUP BY FORNECEDOR, ANO_EMISSAO
HAVING COALESCE(SUM(VLR_RECEBER), 0) <> 0
