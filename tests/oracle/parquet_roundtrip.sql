SELECT cod_filial AS COD_FILIAL, data_movimentacao AS DATA_MOVIMENTACAO, num_pedido AS NUM_PEDIDO,
       cod_vendedor AS COD_VENDEDOR, cod_supervisor AS COD_SUPERVISOR, cod_cliente AS COD_CLIENTE,
       cod_produto AS COD_PRODUTO, CAST(qt_vendida AS DOUBLE) AS QT_VENDIDA,
       CAST(valor_liquido AS DOUBLE) AS VALOR_LIQUIDO, origem_pedido AS ORIGEM_PEDIDO
FROM sales_fact_x
