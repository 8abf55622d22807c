WITH events AS (         -- each event, told to every month start of 2000 whose window holds its day
  SELECT codfilial, codprod, dtmov AS day, 90 AS span, qt AS sold, 0 AS empty_days, 0 AS fresh
  FROM pcmov WHERE codoper = 'S' AND dtcancel IS NULL
  UNION ALL SELECT codfilial, codprod, data, 90, 0, 1, 0 FROM pchistest WHERE qtestger <= 0
  UNION ALL SELECT codfilial, codprod, dtprimcompra, 120, 0, 0, 1 FROM pcest),
signals AS (
  SELECT codfilial, codprod, mes, SUM(sold) AS sold, SUM(empty_days) AS zeros, MAX(fresh) AS fresh
  FROM (SELECT *, unnest(range(1, 13)) AS mes FROM events WHERE day >= DATE '1999-09-01' AND day < DATE '2000-12-01')
  WHERE day < make_date(2000, mes::INTEGER, 1) AND day >= make_date(2000, mes::INTEGER, 1) - span
  GROUP BY codfilial, codprod, mes),
judged AS (              -- money in cents, quantities in hundredths
  SELECT h.codfilial, h.codprod, month(h.data) AS mes, h.qtestger AS stock, h.custorep, m.* EXCLUDE (codprod),
         COALESCE(s.sold, 0) AS units, COALESCE(s.zeros, 0) AS zeros, COALESCE(s.fresh, 0) AS fresh, 90 - COALESCE(s.zeros, 0) AS days,
         CAST(COALESCE(s.sold, 0) * 100 AS HUGEINT) AS sold_cents, CAST(h.custorep * 100 AS HUGEINT) AS cost,
         CASE m.class_code WHEN 'F' THEN 90 WHEN 'H' THEN 60 END AS target
  FROM pchistest AS h JOIN product_master AS m USING (codprod)
  LEFT JOIN signals AS s ON (s.codfilial, s.codprod, s.mes) = (h.codfilial, h.codprod, month(h.data))
  WHERE year(h.data) = 2000 AND day(h.data) = 1
    AND trim(upper(m.departamento)) NOT IN ('IMOBILIZADO', 'ESTOQUE DE INSUMOS', 'MATERIAIS DE CONSUMO')),
needed AS (SELECT *, (CAST(stock AS HUGEINT) * 100 * days - sold_cents * target) * cost AS surplus FROM judged)
SELECT codfilial, classificacao, codprod, produto, categoria, secao, departamento, codcomprador, comprador, codfornec, fornecedor,
       custorep::DOUBLE AS valor_ultima_entrada, stock AS qtd_total_estoque, units::DOUBLE AS qtd_vendas_90d, zeros AS qtd_dias_zerados,
       (stock * cost)::DOUBLE / 100 AS valor_estoque,
       CASE WHEN days <= 0 THEN 0.0 ELSE ((200 * sold_cents + days) // (2 * days))::DOUBLE / 10000 END AS vmd_corrigida,
       CASE WHEN fresh = 1 THEN 0.0 WHEN units = 0 THEN greatest(stock * cost, 0 * cost)::DOUBLE / 100 WHEN target IS NULL THEN 0.0
            WHEN days = 0 OR surplus IS NULL THEN NULL WHEN surplus <= 0 THEN 0.0
            ELSE ((2 * surplus + 100 * days) // (200 * days))::DOUBLE / 100 END AS valor_excedente,
       CASE fresh WHEN 1 THEN 'Sim' ELSE 'Não' END AS is_produto_novo, mes
FROM needed
