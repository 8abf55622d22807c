SELECT l.CODIGOFILIAL AS FILIAL, COALESCE(l.CLASSIFICACAO, 'NÃO CLASSIFICADO') AS CLASSIFICACAO,
       l.DATACADASTRO AS DATA_CADASTRO, l.CODIGOFORNECEDOR, COALESCE(l.FORNECEDOR, 'NÃO DEFINIDO') AS FORNECEDOR,
       l.CODCOMPRADOR, COALESCE(l.COMPRADOR, 'NÃO DEFINIDO') AS COMPRADOR, l.CODIGOCONTA,
       l.NUMEROVERBA AS NUMERO_VERBA, l.NUMNOTA, l.NUMEROTRANSVENDA, l.DATAVENCIMENTO AS DATA_VENCIMENTO,
       l.REFERENCIA, l.REFERENCIA1, l.SITUACAO AS STATUS_VERBA,
       COALESCE(l.VALOR_VERBA, 0) AS VALORVERBA, COALESCE(l.VALORAPLICADO, 0) AS VALOR_APLICADO_TOTAL,
       l.ESTORNOAPLIC, COALESCE(l.VALORDEBITO, 0) AS VALOR_DEBITO, COALESCE(l.VALORCREDITO, 0) AS VALOR_CREDITO,
       l.ESTORNOVERBA, COALESCE(year(l.DATACADASTRO), 0) AS ANOCADASTRO,
       COALESCE(l.VALORDEBITO, 0) + COALESCE(l.VALORCREDITO, 0) AS SALDO_A_RECEBER,
       CASE WHEN date_diff('day', l.DATAVENCIMENTO, DATE '2000-12-31') > 0
            THEN date_diff('day', l.DATAVENCIMENTO, DATE '2000-12-31') ELSE 0 END AS DIAS_VENCIDOS,
       CASE WHEN date_diff('day', l.DATAVENCIMENTO, DATE '2000-12-31') > 0
                 AND COALESCE(l.VALORDEBITO, 0) + COALESCE(l.VALORCREDITO, 0) > 0 THEN 'VENCIDA'
            WHEN COALESCE(l.VALORDEBITO, 0) + COALESCE(l.VALORCREDITO, 0) = 0 THEN 'LIQUIDADA'
            ELSE 'A VENCER' END AS STATUS_VENCIMENTO,
       COALESCE(l.VALOR_VERBA, 0) + COALESCE(l.VALORCREDITO, 0) AS SALDO_A_APLICAR
FROM ledger_x l
WHERE l.CLASSIFICACAO IS DISTINCT FROM 'OUTROS'
