SELECT cod_filial AS codfilial, year(data_movimentacao) AS ano, COUNT(*) AS linhas, COUNT(DISTINCT cod_cliente) AS clientes, true AS dentro_do_erro
FROM sales_fact_x GROUP BY ALL
