SELECT l.CODIGOFILIAL, COALESCE(l.CLASSIFICACAO, 'Não Classificado') AS CLASSIFICACAO, l.DATACADASTRO,
       l.CODIGOFORNECEDOR, l.FORNECEDOR, l.CODCOMPRADOR, l.COMPRADOR, l.NUMEROVERBA,
       COALESCE(l.VALOR_VERBA, 0) AS VALOR_VERBA, COALESCE(l.VALORDEBITO, 0) AS VALORDEBITO,
       COALESCE(l.VALORCREDITO, 0) AS VALORCREDITO,
       COALESCE(l.VALORDEBITO, 0) + COALESCE(l.VALORCREDITO, 0) AS VLR_RECEBER,
       COALESCE(year(l.DATACADASTRO), 0) AS ANO_EMISSAO
FROM ledger_x l
WHERE l.CODIGOFILIAL BETWEEN 1 AND 7
  AND COALESCE(l.CLASSIFICACAO, 'Não Classificado') = 'FARMA'
  AND COALESCE(year(l.DATACADASTRO), 0) = 1999
