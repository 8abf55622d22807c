WITH gates AS (SELECT codtabela, codigoa, codigon FROM pclib WHERE codfunc = 608 AND codigoa IS NOT NULL),
titles AS (
  SELECT t.codcli, t.codfilial, t.dtemissao, t.dtvenc, t.dtpag, t.valor
  FROM pcprest AS t JOIN pcusuari AS u USING (codusur) JOIN pcsuperv AS s ON s.codsupervisor = COALESCE(t.codsupervisor, u.codsupervisor)
  WHERE t.dtemissao >= DATE '1998-01-01' AND t.valor <> 0 AND t.codcob IN (SELECT codcob FROM pccob)
    AND t.codcob NOT IN ('DESD', 'DEVP', 'DEVT', 'BNF', 'BNFT', 'BNFR', 'BNTR', 'BNRP', 'CRED')
    AND (t.codcob IN (SELECT codigoa FROM gates WHERE codtabela = '8') OR '9999' IN (SELECT codigoa FROM gates WHERE codtabela = '8'))
    AND (s.codsupervisor IN (SELECT codigon FROM gates WHERE codtabela = '7' AND codigon IS NOT NULL)
         OR 9999 IN (SELECT codigon FROM gates WHERE codtabela = '7' AND codigon IS NOT NULL))),
owed AS (
  SELECT maker.*, titles.codfilial, titles.dtemissao, titles.dtvenc, titles.dtpag, titles.valor
  FROM titles JOIN pcfornec AS maker USING (codcli) WHERE codcli IN (SELECT codcli FROM pcclient))
SELECT COALESCE(class_names.upper_name, 'OUTROS') AS CLASSIFICACAO, owed.codfilial AS FILIAL, owed.codfornec AS CODFORNEC,
       owed.fornecedor AS FORNECEDOR, buyer.nome AS COMPRADOR, SUM(owed.valor) AS VALOR_VERBA_DEVOLUCAO, owed.dtemissao AS DTEMISSAO,
       owed.dtvenc AS DATA_VENCIMENTO, owed.dtpag AS DATA_PAGAMENTO
FROM owed JOIN pcempr AS buyer ON buyer.matricula = owed.codcomprador LEFT JOIN class_names ON class_names.code = owed.classificacao
GROUP BY owed.classificacao, class_names.upper_name, owed.codfilial, owed.codfornec, owed.fornecedor, buyer.nome, owed.dtemissao, owed.dtvenc, owed.dtpag
