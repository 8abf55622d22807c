SELECT m.codfilial AS filial, m.codprod, EXTRACT(DAY FROM m.dtmov) AS dia_faturamento, p.codemitente AS codigo_rca,
       CAST(SUM(ROUND((COALESCE(m.punit, 0) + COALESCE(m.vloutrasdesp, 0) + COALESCE(m.vlfrete_rateio, 0)
                       + COALESCE(m.vloutros, 0) - COALESCE(m.vlipi, 0) - COALESCE(m.st, 0) - COALESCE(m.vlrepasse, 0)
                       + COALESCE(m.vlipi, 0) + COALESCE(m.st, 0)) * COALESCE(m.qt, 0), 2)) AS DOUBLE) AS faturamento
FROM pcmov m
JOIN pcpedc p ON p.numped = m.numped
WHERE m.dtmov BETWEEN DATE '2000-11-01' AND DATE '2000-11-30' AND m.codoper = 'S'
  AND m.dtcancel IS NULL AND m.codfilial <> 10 AND p.origemped = 'T' AND p.dtcancel IS NULL AND p.codemitente <> 8888
GROUP BY EXTRACT(DAY FROM m.dtmov), m.codfilial, m.codprod, p.codemitente
