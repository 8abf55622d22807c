SELECT * REPLACE (qt_vendida::DOUBLE AS qt_vendida, valor_bruto::DOUBLE AS valor_bruto, valor_liquido::DOUBLE AS valor_liquido)
FROM sales_fact_x WHERE data_movimentacao >= DATE '2000-01-01'
