WITH r AS (SELECT * FROM returns_paid_x)
SELECT FILIAL, CODFORNEC, DTEMISSAO, DATA_VENCIMENTO, DATA_PAGAMENTO, VALOR_VERBA_DEVOLUCAO::DOUBLE AS VALOR_VERBA_DEVOLUCAO,
       row_number() OVER (PARTITION BY FILIAL ORDER BY DATA_VENCIMENTO ASC NULLS LAST, DATA_PAGAMENTO DESC NULLS FIRST, CODFORNEC NULLS LAST,
         DTEMISSAO NULLS LAST, VALOR_VERBA_DEVOLUCAO NULLS LAST, COMPRADOR NULLS LAST) AS lugar_extrato,
       row_number() OVER (PARTITION BY FILIAL ORDER BY DATA_PAGAMENTO DESC NULLS LAST, VALOR_VERBA_DEVOLUCAO DESC NULLS LAST, CLASSIFICACAO ASC NULLS LAST,
         CODFORNEC NULLS LAST, DTEMISSAO NULLS LAST, COMPRADOR NULLS LAST, DATA_VENCIMENTO NULLS LAST) AS lugar_analise
FROM r
