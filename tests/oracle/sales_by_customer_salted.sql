SELECT client.cliente, SUM(m.qt)::DOUBLE AS qt, COUNT(*) AS linhas
FROM (SELECT CASE WHEN numped % 2 = 0 THEN 1 WHEN numped % 5 > 0 THEN codcli END AS codcli, qt FROM pcmov) AS m
LEFT JOIN pcclient AS client USING (codcli) GROUP BY client.cliente
