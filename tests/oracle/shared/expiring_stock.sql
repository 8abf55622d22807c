WITH lots AS (           -- every lot row knows the quantity of lot '1' beside it
  SELECT codendereco, codprod, numlote, dtval AS lot_day, qt AS lot_units,
         SUM(CASE numlote WHEN '1' THEN qt END) OVER (PARTITION BY codendereco, codprod, dtval) AS first_lot
  FROM pcestenderecoi),
due AS (
  SELECT a.codendereco, a.codprod, a.qt AS units, l.numlote, l.lot_day, l.lot_units, l.first_lot, COALESCE(l.lot_day, a.dtval) AS day
  FROM pcestendereco AS a LEFT JOIN lots AS l USING (codendereco, codprod)
  WHERE a.qt > 0 AND COALESCE(l.lot_day, a.dtval) BETWEEN DATE '2000-01-01' AND DATE '2000-08-31'),
rules AS (SELECT DISTINCT codprod, estoquepordtvalidadepk = 'S' AS dated FROM pcprodfilial)
SELECT place.codfilial, m.classificacao, m.fornecedor, due.codprod, m.produto AS descricao, due.numlote, due.day AS data_validade,
       ROUND(cost.custoultent, 2) AS valor_ultima_entrada,
       CASE WHEN due.lot_units IS NULL THEN due.units WHEN goods.estoqueporlote = 'S' THEN due.lot_units
            WHEN rules.dated AND due.lot_day IS NOT NULL AND due.numlote = '1' AND place.tipoender = 'AP' THEN COALESCE(due.first_lot, 0)
            ELSE due.units END AS qt
FROM due JOIN rules USING (codprod) JOIN product_master AS m USING (codprod) JOIN pcprodut AS goods USING (codprod)
JOIN pcendereco AS place USING (codendereco)
LEFT JOIN pcest AS cost ON cost.codprod = due.codprod AND cost.codfilial = place.codfilial
WHERE m.class_code IN ('F', 'H') AND qt > 0
