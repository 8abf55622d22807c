WITH signals AS (        -- what happened to a product at a branch in the windows that end on the day of the report
  SELECT codfilial, codprod, SUM(sold) AS sold, SUM(empty_days) AS zeros, MAX(bought) AS bought
  FROM (SELECT codfilial, codprod, qt AS sold, 0 AS empty_days, NULL::DATE AS bought
        FROM pcmov WHERE codoper = 'S' AND dtmov BETWEEN DATE '2000-04-02' AND DATE '2000-07-01'
        UNION ALL SELECT codfilial, codprod, 0, 1, NULL FROM pchistest
        WHERE qtestger = 0 AND data BETWEEN DATE '2000-04-02' AND DATE '2000-07-01'
        UNION ALL SELECT codfilial, codprod, 0, 0, dtprimcompra FROM pcest
        WHERE dtprimcompra BETWEEN DATE '2000-03-03' AND DATE '2000-07-01')
  GROUP BY ALL),
balance AS (             -- cover in hundredths, value in cents: every quotient is rounded half up in integers
  SELECT codfilial, codprod, custoultent, SUM(qtestger) AS stock, SUM(qtgirodia) AS turn,
         CASE WHEN turn > 0 THEN sign(stock) * ((200 * abs(stock) + turn) // (2 * turn)) ELSE 0 END::HUGEINT AS cover,
         stock * CAST(custoultent * 100 AS HUGEINT) AS cents
  FROM pcest WHERE codfilial <> 10 AND qtestger <> 0 GROUP BY codfilial, codprod, custoultent),
judged AS (
  SELECT b.*, m.* EXCLUDE (codprod), COALESCE(s.sold, 0) AS units, COALESCE(s.zeros, 0) AS zeros, s.bought,
         90 - COALESCE(s.zeros, 0) AS days, CAST(COALESCE(s.sold, 0) * 100 AS HUGEINT) AS sold_cents,
         cents * (cover - CASE m.class_code WHEN 'F' THEN 9000 ELSE 6000 END) AS beyond
  FROM balance AS b JOIN product_master AS m USING (codprod) LEFT JOIN signals AS s USING (codfilial, codprod)
  WHERE m.class_code IN ('F', 'H'))
SELECT codfilial, classificacao, codprod, produto, categoria, secao, departamento, codcomprador AS cod_comprador, comprador,
       codfornec, fornecedor, custoultent::DOUBLE AS valor_ultima_entrada, stock AS qtd_total_estoque, turn AS qtd_giro_dia,
       cover::DOUBLE / 100 AS cobertura_estoque_original, CASE units WHEN 0 THEN 9999.0 ELSE cover::DOUBLE / 100 END AS cobertura_estoque_ajustada,
       units::DOUBLE AS qtd_vendas_90d, zeros AS qtd_dias_zerados, cents::DOUBLE / 100 AS valor_estoque,
       CASE WHEN days > 0 THEN ((2 * sold_cents + days) // (2 * days))::DOUBLE / 100 END AS giro_medio_corrigido,
       CASE WHEN bought IS NOT NULL OR units = 0 OR cover = 0 THEN 0.0 WHEN beyond IS NULL THEN NULL
            WHEN (beyond < 0) = (cover < 0) THEN ((2 * abs(beyond) + abs(cover)) // (2 * abs(cover)))::DOUBLE / 100 ELSE 0.0 END AS valor_excedente,
       CASE WHEN bought IS NULL THEN 'Não' ELSE 'Sim' END AS is_produto_novo, bought AS data_primeira_compra
FROM judged
