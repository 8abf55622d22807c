SELECT classificacao, codfilial, COALESCE(SUM(qtestger), 0) AS Soma_de_qtestger
FROM stock_by_class GROUP BY classificacao, codfilial
