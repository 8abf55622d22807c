SELECT c.codfilial AS filial, c.codemitente AS cod_televenda, e.nome AS nm_televenda, s.codsupervisor,
       s.nome AS supervisor, c.codcli AS cod_cliente, cli.cliente AS nm_cliente, i.codprod AS cod_produto,
       pr.descricao AS nm_produto, CAST(i.qt AS DOUBLE) AS qt_vendida, CAST(i.pvenda AS DOUBLE) AS vl_venda,
       i.posicao AS posicao_pedido
FROM pcpedc c
LEFT JOIN pcpedi i ON i.numped = c.numped
LEFT JOIN pcempr e ON e.matricula = c.codemitente
LEFT JOIN pcclient cli ON cli.codcli = c.codcli
LEFT JOIN pcprodut pr ON pr.codprod = i.codprod
LEFT JOIN pcusuari u ON u.codusur = e.codusur
LEFT JOIN pcsuperv s ON s.codsupervisor = u.codsupervisor
WHERE c.data = DATE '2000-12-09' AND c.condvenda IN (1, 5) AND c.codemitente <> 8888
