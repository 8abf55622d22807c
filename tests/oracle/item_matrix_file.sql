SELECT nm_cliente, nm_produto, lpad(MES::VARCHAR, 2, '0') || '/' || ANO::VARCHAR AS MES, SUM(QT_VENDIDA)::DOUBLE AS QT_VENDIDA
FROM sales_base GROUP BY nm_cliente, nm_produto, ANO, sales_base.MES HAVING SUM(QT_VENDIDA) <> 0
