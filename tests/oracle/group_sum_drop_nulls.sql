SELECT classificacao, codfilial, COALESCE(SUM(qtestger), 0) AS Soma_de_qtestger
FROM stock_by_class WHERE classificacao IS NOT NULL AND codfilial IS NOT NULL GROUP BY classificacao, codfilial
