SELECT CODIGOFILIAL, CLASSIFICACAO, DATACADASTRO, CODIGOFORNECEDOR, FORNECEDOR, CODCOMPRADOR, COMPRADOR, CODIGOCONTA,
       NUMEROVERBA, NUMNOTA, NUMEROTRANSVENDA, DATAVENCIMENTO, REFERENCIA, REFERENCIA1, SITUACAO,
       CAST(VALOR_VERBA AS DOUBLE) AS VALOR_VERBA, CAST(VALORAPLICADO AS DOUBLE) AS VALORAPLICADO, ESTORNOAPLIC,
       CAST(VALORDEBITO AS DOUBLE) AS VALORDEBITO, CAST(VALORCREDITO AS DOUBLE) AS VALORCREDITO, ESTORNOVERBA
FROM ledger_x
