WITH o AS (
  SELECT nm_cliente, NUM_PEDIDO, SUM(VALOR_LIQUIDO) AS valor, MAX(DATA_MOVIMENTACAO) AS dia, MAX(COD_VENDEDOR) AS rep
  FROM sales_base GROUP BY nm_cliente, NUM_PEDIDO),
c AS (
  SELECT nm_cliente, first(rep ORDER BY dia DESC, NUM_PEDIDO DESC) AS rep, SUM(valor) AS LTV, COUNT(*) AS PEDIDOS,
         MAX(dia) AS ULTIMA_COMPRA
  FROM o GROUP BY nm_cliente),
names AS (SELECT DISTINCT COD_VENDEDOR, nm_vendedor FROM sales_base)
SELECT c.nm_cliente, n.nm_vendedor AS VENDEDOR, CAST(c.LTV AS DOUBLE) AS LTV, c.PEDIDOS, c.ULTIMA_COMPRA,
       CAST(c.LTV AS DOUBLE) / CAST(c.PEDIDOS AS DOUBLE) AS TICKET_MEDIO,
       date_diff('day', c.ULTIMA_COMPRA, (SELECT MAX(DATA_MOVIMENTACAO) FROM sales_base)) AS DIAS_INATIVO,
       date_diff('day', c.ULTIMA_COMPRA, (SELECT MAX(DATA_MOVIMENTACAO) FROM sales_base)) < 30 AS RECENTE
FROM c LEFT JOIN names n ON c.rep = n.COD_VENDEDOR
