WITH bought AS (SELECT DISTINCT nm_cliente, categoria FROM sales_base),
b AS (SELECT nm_cliente, COUNT(*) AS n_b,
             string_agg(CASE WHEN categoria <> 'NAO CADASTRADO' THEN categoria END, ', ' ORDER BY categoria) AS atuais
      FROM bought GROUP BY nm_cliente),
m AS (SELECT nm_cliente, COUNT(*) AS n_m, string_agg(categoria, ', ' ORDER BY categoria) AS faltantes
      FROM customer_gaps GROUP BY nm_cliente)
SELECT b.nm_cliente, b.n_b AS N_CATEGORIAS_CLIENTE,
       (SELECT COUNT(DISTINCT categoria) FROM sales_base) AS N_CATEGORIAS_TOTAL,
       COALESCE(b.atuais, '') AS CATEGORIAS_ATUAIS, COALESCE(m.n_m, 0) AS N_FALTANTES,
       COALESCE(m.faltantes, '') AS CATEGORIAS_FALTANTES
FROM b LEFT JOIN m ON b.nm_cliente = m.nm_cliente
