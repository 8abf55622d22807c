SELECT nm_cliente AS CLIENTE,
       COUNT(DISTINCT CASE WHEN ANO = 1999 THEN categoria END) - COUNT(DISTINCT CASE WHEN ANO = 2000 THEN categoria END) AS PERDA_DE_MIX
FROM sales_base
GROUP BY nm_cliente
HAVING COUNT(DISTINCT CASE WHEN ANO = 1999 THEN categoria END) - COUNT(DISTINCT CASE WHEN ANO = 2000 THEN categoria END) > 0
ORDER BY PERDA_DE_MIX DESC, CLIENTE
LIMIT 20
