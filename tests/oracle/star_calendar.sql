SELECT DISTINCT year(data_movimentacao) AS ano, month(data_movimentacao) AS mes, year(data_movimentacao) * 12 + month(data_movimentacao) - 1 AS indice,
       date_trunc('month', data_movimentacao)::DATE AS primeiro_dia
FROM sales_fact_x
