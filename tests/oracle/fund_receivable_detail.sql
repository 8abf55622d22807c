SELECT CODIGOFILIAL, FORNECEDOR, CAST(VALORDEBITO AS DOUBLE) AS VALORDEBITO, CAST(VALORCREDITO AS DOUBLE) AS VALORCREDITO,
       CAST(VLR_RECEBER AS DOUBLE) AS VLR_RECEBER
FROM r15_main WHERE VLR_RECEBER > 0
